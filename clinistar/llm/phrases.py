"""Operator 12: phrase collocations by direct-address tiling.

Words get ids by their rank in frequency, so frequent pairs of ids lie in the
corner of the pair matrix. The matrix is cut into square tiles. A tile that
holds many of the pairs at hand is counted by its addresses, with one dense
``bincount``; the pairs of all sparse tiles are counted as sorted coordinates.
Frequent pairs are then ranked like words, and a pair with the word behind it
is counted in the same way: so phrases grow word by word.

A phrase that comes ``LEAST`` times consists of words and shorter phrases that
do so too, so only those get ids; all others are breaks from then on.

Texts are read once, into chunks of bounded size: the chunk's own dictionary,
and its words as places in it. Only the dictionaries meet the corpus-wide
counts and ranks, a row per distinct word (then pair) of a chunk, and go back
to their chunk as a whole. Counts are added up by Spark over rows that are
already combined per chunk, so a frequent word or a language with a third of
all rows is a few rows a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinistar.llm.common import discard, staged, table

#: Words of the longest phrase, and how often a candidate comes at least.
MAX_WORDS, LEAST = 3, 10
#: A candidate goes if a longer one around it has this share of its count, in percent.
INSIDE = 50
#: Phrases returned per language.
TOP = 2000
#: Words of a chunk, about; a task holds twice as many at most. A longer text
#: is in one chunk.
CHUNK = 1 << 20
#: Side of a tile, and the pairs per cell from which one is counted densely.
TILE, DENSE = 1024, 1 / 16
#: Tiles per side that may be dense: ids beyond are rare.
CORNER = 8
#: Phrases of the most frequent ranks that every task has: 8 MB. The others are joined.
HEAD = 1 << 19
#: Bits of the bitmap of known phrases and of a piece of it, as powers of two.
BITMAP_BITS, BITMAP_PIECE = 28, 17
#: Rows that a task hands on at once.
BATCH_ROWS = 1 << 16
#: Parts in which a language's best are sought first.
PARTS = 64

#: floor(1000000 * a * a / (l * r)), exact for counts below 10**15.
SCORE = "(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"

#: Signs that end a piece become full stops, tabs become spaces.
SIGNS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")
BREAK = b"."


# --- counting ----------------------------------------------------------------
def counted(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs ``left << 32 | right``, sorted, and their counts."""
    codes = left << 32 | right
    corner = (left < TILE * CORNER) & (right < TILE * CORNER)
    tiles = left[corner] // TILE * CORNER + right[corner] // TILE
    many = np.bincount(tiles, minlength=CORNER * CORNER) >= DENSE * TILE * TILE
    dense = np.zeros(len(codes), bool)
    dense[corner] = many[tiles]
    found, counts = np.unique(codes[~dense], return_counts=True)
    found, counts = [found], [counts]
    order = np.argsort(tiles[many[tiles]], kind="stable")
    rows = np.flatnonzero(dense)[order]
    bounds = np.searchsorted(tiles[many[tiles]][order], np.arange(CORNER * CORNER + 1))
    for tile in np.flatnonzero(many):
        own = rows[bounds[tile] : bounds[tile + 1]]
        cells = np.bincount(left[own] % TILE * TILE + right[own] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        found.append((at // TILE + tile // CORNER * TILE) << 32 | (at % TILE + tile % CORNER * TILE))
        counts.append(cells[at])
    found, counts = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(found)
    return found[order], counts[order]


def ranked(df: DataFrame, by: list[Column], label: str) -> DataFrame:
    """``df`` with ``id``: 0, 1, ... in the order ``by``, which has no ties.

    Rows are dealt to ranges and numbered in each; a range starts where those
    before it end. The table is written in between, so both see one dealing.
    """
    dealt = staged(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("nth", F.monotonically_increasing_id()), label)
    part = F.shiftright("nth", 33)
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("nth").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(F.broadcast(starts), part == F.col("part")).select(*df.columns, place.alias("id"))


# --- chunks ------------------------------------------------------------------
class Places(dict):
    """The place of a word in a dictionary; a new word takes the next one."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


def words(text: str | None) -> list[bytes]:
    """The words in lower case (A to Z), with ``BREAK`` between pieces."""
    if not text:
        return []
    return text.encode("utf-8", "replace").lower().translate(SIGNS).replace(BREAK, b" . ").split()  # spaces are the only blanks left


def chunks(docs: DataFrame) -> DataFrame:
    """``chunk, lang, words, counts, places``: a chunk's dictionary, how often
    each of its words comes, and all its words as places in it (packed int32).
    Place 0 is a break; there is one between texts."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[Places, list]] = {}
        size: dict[str, int] = {}
        seq = TaskContext.get().partitionId() << 32

        def chunk(lang: str) -> pd.DataFrame:
            nonlocal seq
            seq += 1
            known, texts = held.pop(lang)
            del size[lang]
            places = np.concatenate(texts)
            counts = np.bincount(places, minlength=len(known))
            names = [w.decode("utf-8", "replace") for w in known]
            return pd.DataFrame([(seq, lang, names, counts, places.tobytes())], columns=["chunk", "lang", "words", "counts", "places"])

        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                got = words(text)
                if not got:
                    continue
                known, texts = held.setdefault(lang, (Places({BREAK: 0}), []))
                got.append(BREAK)
                texts.append(np.fromiter(map(known.__getitem__, got), np.int32, len(got)))
                size[lang] = size.get(lang, 0) + len(got)
                if size[lang] >= CHUNK:
                    yield chunk(lang)
                elif sum(size.values()) >= 2 * CHUNK:
                    yield chunk(max(size, key=size.get))
        for lang in list(held):
            yield chunk(lang)

    cut = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return cut.mapInPandas(read, "chunk long, lang string, words array<string>, counts array<long>, places binary")


def heads_and_words(row, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word ids, the ids of the phrases of ``n_words - 1`` words that start at
    each, and the words behind those; -1 where there is none. And where a
    phrase of ``n_words`` may be frequent: its first words and its last words
    both are."""
    ids = np.frombuffer(row.ids, np.int32).astype(np.int64)
    heads = ids if row.heads is None else np.frombuffer(row.heads, np.int32).astype(np.int64)
    behind = np.full(len(ids), -1, np.int64)
    behind[: max(0, len(ids) - n_words + 1)] = ids[n_words - 1 :]
    both = (heads >= 0) & (behind >= 0) & (np.append(heads[1:], -1) >= 0)
    return ids, heads, behind, both


def grown(row, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``counted`` of a chunk's phrases of ``n_words`` words."""
    _, heads, behind, both = heads_and_words(row, n_words)
    return counted(heads[both], behind[both])


def phrase_counts(read: DataFrame, n_words: int) -> DataFrame:
    """``code, f`` of all phrases of ``n_words`` words, added up over chunks."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                codes, counts = grown(row, n_words)
                for at in range(0, len(codes), BATCH_ROWS):
                    yield pd.DataFrame({"code": codes[at : at + BATCH_ROWS], "f": counts[at : at + BATCH_ROWS]})

    return read.select("ids", "heads").mapInPandas(rows, "code long, f long").groupBy("code").agg(F.sum("f").alias("f"))


def in_head(head, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``codes`` are among the most frequent phrases, and the ids of those."""
    known, ids = head.value
    at = np.searchsorted(known, codes)
    found = at < len(known)
    found[found] = known[at[found]] == codes[found]
    return found, ids[at[found]]


def listed_phrases(read: DataFrame, n_words: int, bits, head) -> DataFrame:
    """``chunk, place, code``: each chunk's distinct phrases, with their places
    in that list, but for the most frequent ones and those that ``bits`` rules
    out."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                codes, _ = grown(row, n_words)
                place = np.flatnonzero(maybe(bits.value, mixed(codes)) & ~in_head(head, codes)[0])
                for at in range(0, len(place), BATCH_ROWS):
                    some = place[at : at + BATCH_ROWS]
                    yield pd.DataFrame({"chunk": row.chunk, "place": some.astype(np.int32), "code": codes[some]})

    return read.mapInPandas(rows, "chunk long, place int, code long")


def by_chunk(read: DataFrame, names: DataFrame, step) -> DataFrame:
    """``chunk, ids, heads`` of every chunk after ``step(row, place, id)``.
    ``names``: ``chunk, place, id``, a row for each place that has an id."""

    def work(rows: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        out = [(row.of, *step(row, names["place"].to_numpy(np.int64), names["id"].to_numpy(np.int64))) for row in rows.itertuples()]
        return pd.DataFrame(out, columns=["chunk", "ids", "heads"])

    schema = "chunk long, ids binary, heads binary"
    return read.withColumnRenamed("chunk", "of").groupBy("of").cogroup(names.groupBy("chunk")).applyInPandas(work, schema)


def word_ids(row, place: np.ndarray, number: np.ndarray) -> tuple[bytes, None]:
    """A chunk's places as word ids; each word is a head of its own."""
    lookup = np.full(int(row.size), -1, np.int64)
    lookup[place] = number
    ids = lookup[np.frombuffer(row.places, np.int32)]
    kept = ids >= 0
    kept[1:] |= kept[:-1].copy()  # one break is enough
    return ids[kept].astype(np.int32).tobytes(), None


def phrase_ids(n_words: int, head):
    """Heads one word longer: phrases of ``n_words`` words."""

    def step(row, place: np.ndarray, number: np.ndarray) -> tuple[bytes, bytes]:
        codes, _ = grown(row, n_words)
        lookup = np.full(len(codes), -1, np.int64)
        lookup[place] = number
        frequent, number = in_head(head, codes)
        lookup[frequent] = number
        _, heads, behind, both = heads_and_words(row, n_words)
        out = np.full(len(heads), -1, np.int64)
        out[both] = lookup[np.searchsorted(codes, heads[both] << 32 | behind[both])]
        return row.ids, out.astype(np.int32).tobytes()

    return step


# --- which phrases may have an id ---------------------------------------------
def mixed(codes: np.ndarray) -> np.ndarray:
    """Random-looking 64 bits of each code."""
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; true for all hashes it was made from."""
    at = hashes.view(np.uint64) & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """The bits of the column ``h`` of ``hashes``, about ``n`` rows. At most
    ``BITMAP_BITS``: beyond, it fills up and rules out less, which costs work
    and changes nothing. It is made piece by piece."""
    size = 1 << max(BITMAP_PIECE, min(BITMAP_BITS, (16 * n).bit_length()))

    def piece(rows: pd.DataFrame) -> pd.DataFrame:
        bit = np.zeros(1 << BITMAP_PIECE, np.uint8)
        bit[rows["at"].to_numpy() & ((1 << BITMAP_PIECE) - 1)] = 1
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "bits": [np.packbits(bit, bitorder="little").tobytes()]})

    at = hashes.select(F.col("h").bitwiseAND(F.lit(size - 1)).alias("at")).distinct().withColumn("piece", F.shiftright("at", BITMAP_PIECE).cast("int"))
    out = np.zeros(size >> 3, np.uint8)
    step = 1 << (BITMAP_PIECE - 3)
    for number, bits in at.groupBy("piece").applyInPandas(piece, "piece int, bits binary").collect():  # 32 MB at most
        out[number * step : (number + 1) * step] = np.frombuffer(bits, np.uint8)
    return out


# --- phrases -----------------------------------------------------------------
def phrases(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``max_words`` words that come ``least`` times:
    ``lang, phrase, n_words, f``; and ``lang, n`` with a language's words."""
    spark = docs.sparkSession
    read = staged(chunks(docs), "phrases-chunks")
    listed = read.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).where("place > 0")
    listed = listed.select("chunk", "lang", "place", F.col("w.words").alias("phrase"), F.col("w.counts").alias("f"))
    all_words = staged(listed.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrases-words")
    totals = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    order = [F.desc("f"), F.asc("lang"), F.asc("phrase")]
    known = staged(ranked(all_words.where(F.col("f") >= least), order, "phrases-ranked"), "phrases-ids")
    word_hash = F.xxhash64("lang", "phrase")
    bits = spark.sparkContext.broadcast(bitmap(known.select(word_hash.alias("h")), known.count()))

    @F.pandas_udf("boolean")
    def may_be_known(h: pd.Series) -> pd.Series:
        return pd.Series(maybe(bits.value, h.to_numpy()))

    some = listed.select("chunk", "lang", "place", "phrase").where(may_be_known(word_hash))
    names = some.join(known, ["lang", "phrase"]).select("chunk", "place", "id")
    before, read = read, staged(by_chunk(read.select("chunk", "places", F.size("words").alias("size")), names, word_ids), "phrases-sequences")
    discard(spark, before)
    words_of, found = known.select(F.col("id").alias("word_id"), F.col("phrase").alias("word")), [known]
    for n_words in range(2, max_words + 1):
        counts = ranked(phrase_counts(read, n_words).where(F.col("f") >= least), [F.desc("f"), F.asc("code")], "phrases-ranked")
        heads = known.select(F.col("id").alias("head_id"), F.col("phrase").alias("head"), "lang")
        longer = counts.join(heads, F.shiftright("code", 32) == F.col("head_id")).join(words_of, F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("word_id"))
        known = staged(longer.select("lang", F.concat_ws(" ", "head", "word").alias("phrase"), "f", "id", "code"), "phrases-ids")
        found.append(known)
        if n_words < max_words:
            first = known.where(F.col("id") < HEAD).select("code", "id").mapInPandas(packed, "codes binary, ids binary").collect()
            codes, ids = (np.frombuffer(b"".join(r[k] for r in first), np.int64) for k in range(2))
            order = np.argsort(codes)
            head = spark.sparkContext.broadcast((codes[order], ids[order]))
            rest = known.where(F.col("id") >= HEAD).select("code", "id")
            bits = spark.sparkContext.broadcast(bitmap(rest.select("code").mapInPandas(hashed, "h long"), rest.count()))
            names = listed_phrases(read, n_words, bits, head).join(rest, "code").select("chunk", "place", "id")
            read = by_chunk(read, names, phrase_ids(n_words, head))
            if n_words + 1 < max_words:  # else it is used once
                read = staged(read, "phrases-sequences")
            discard(spark)
    every = [t.select("lang", "phrase", F.lit(k + 1).alias("n_words"), "f") for k, t in enumerate(found)]
    return reduce(DataFrame.unionByName, every), totals


def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([[b[c].to_numpy(np.int64).tobytes() for c in ("code", "id")]], columns=["codes", "ids"])


def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"h": mixed(b["code"].to_numpy())})


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` needs ``text, lang``; other columns are ignored. A null language
    is ``und``, a null or empty text has no words. Texts of any length are
    read whole. Repeated rows count each. Order: score and count descending,
    then the phrase's bytes, so there are no ties. No rows give no rows.
    Counts below 10**15 give exact scores.
    """
    every, totals = phrases(docs, max_words, least)
    every = staged(every, "phrases-all")
    long = every.where("n_words > 1")
    split = F.split("phrase", " ")
    part = lambda start, n: F.concat_ws(" ", F.slice("w", start, n))
    cuts = long.withColumn("w", split).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    count_of = lambda name, f: every.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(count_of("first", "l"), ["lang", "first"]).join(count_of("rest", "r"), ["lang", "rest"])
    scored = cuts.withColumn("score", F.expr(SCORE))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    scored = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "low.l", "low.r", "low.score")

    size = F.explode(F.expr("sequence(2, n_words - 1)"))
    inner = long.where("n_words > 2").withColumn("w", split).withColumn("size", size)
    inner = inner.withColumn("start", F.explode(F.expr("sequence(1, n_words - size + 1)")))
    inner = inner.select("lang", part(F.col("start"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {INSIDE} * a")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    kept = kept.withColumn("nth", F.row_number().over(some)).where(F.col("nth") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, greatest(1, len(w) - k + 2)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k),
every AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM every WHERE k = 1 GROUP BY lang),
long AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM every WHERE k > 1 AND f >= {LEAST}),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM long),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.f AS l, r.f AS r,
         ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN every l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
              JOIN every r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM long WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM long WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT s.* FROM lowest s LEFT JOIN around x ON x.lang = s.lang AND x.phrase = s.phrase
         WHERE x.a IS NULL OR 100 * x.a < {INSIDE} * s.a),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT m.lang, m.rank::BIGINT AS rank, m.phrase, m.a, m.l, m.r, t.n, m.score
FROM numbered m JOIN totals t ON t.lang = m.lang WHERE m.rank <= {TOP}
"""
