"""Operator 7: n-gram Jaccard join by prefixes under several token orders.

Two documents are similar if their sets of five-word shingles have a Jaccard
similarity of at least 0.75. Then each has at least 75 % of its shingles in
common with the other, so under any order of all tokens their first
``n - ceil(0.75 n) + 1`` tokens, the prefix, share one.

1. Tokens are counted over all texts: some are in a single text, most in a
   few, and those of passages that many texts share in ``COMMON`` or more.
   What is left of the counts is two bits a token, in bitmaps of bounded size
   (``BITMAP_BITS``): once they are full they miss some of the lone tokens or
   call rare ones common, which costs work and changes nothing.
2. Lone tokens can't be shared, and every order puts them first; common ones
   come last, so a shared passage is in few prefixes. A text with more than
   25 % lone tokens is similar to no other. The others become one row per
   distinct set, with their prefixes under ``ORDERS`` orders: a different hash
   each inside the three classes.
3. Candidates share a prefix token of the first order, their sizes without
   lone tokens allow the similarity, and they also share a prefix token under
   each other order. The sizes of a pair say how much it has to share, which
   makes its prefixes shorter. Then the shared tokens are counted.
4. Only the components matter, so not all pairs of a bucket (the sets with a
   prefix token) are tried. First each set meets one other: of its buckets'
   centres, the sets with the fewest lone tokens, the best. Sets that are then
   connected need no more. A second round has centres from the rest; after
   it, the pairs of a bucket that aren't connected yet are candidates, all of
   them. A large bucket is dealt to blocks that meet in pairs. Nothing is
   capped.
5. A pair is first compared by 32 bits of its tokens, which can only find too
   much in common, and what passes by all 64.

Tokens and sets are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinistar.llm.common import ASCII_BLANKS, discard, staged, table
from clinistar.llm.components import components

WORDS = 5
#: Similarity in percent.
PERCENT = 75
ORDERS = 3
#: Bits of the bitmap at most, and for each token that isn't alone.
BITMAP_BITS, BITS_A_TOKEN = 1 << 28, 16
#: Tokens counted together, about.
RANGE_TOKENS = 1 << 21
#: Tokens that a task gathers before it sends them on.
GATHERED = 1 << 19
STARS = 2
#: Texts from which on a token is common.
COMMON = 64
#: Sets of a bucket, or of a block of a larger one, that meet another block.
BLOCK_SETS = 2048
#: Ids of candidates that are sent to all tasks, at most; beyond that they are joined.
SENT_IDS = 1 << 20

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


_hash = _Hashes()


def mixed(x: np.ndarray, order: int = 0) -> np.ndarray:
    """A different random-looking permutation of 64-bit numbers for each order."""
    x = x * ODD[0] + np.uint64(int(ODD[1]) * order % 2**64)
    x = (x ^ (x >> np.uint64(29))) * ODD[2]
    x = (x ^ (x >> np.uint64(32))) * ODD[4]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; fewer words than ``k`` are one."""
    words = text.encode("utf-8", "replace").lower().split() if text else ()  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    if len(h) < k:
        h = np.r_[h, np.full(k - len(h), len(h), np.uint64)]
        return mixed((h * ODD).sum(keepdims=True), 7)
    n = len(h) - k + 1
    total = h[:n] * ODD[0]
    for j in range(1, k):
        total = total + h[j : j + n] * ODD[j]
    return np.unique(mixed(total))


def set_id(tokens: np.ndarray) -> int:
    return int(mixed(mixed(tokens, 9).sum(keepdims=True) + np.uint64(len(tokens)), 11).view(np.int64)[0])


def needed(n: int) -> int:
    """The tokens that a set of ``n`` shares with any similar one, at least."""
    return -(-PERCENT * n // 100)


def bitmap(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bit for each value of the tokens' leading bits: 1 if some token with
    them may be in more than one text; and 1 if one may be common."""
    total = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
    bits = max(0, math.ceil(math.log2(max(1, total) / RANGE_TOKENS)))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, seen = [], 0, set()

        def send() -> pd.DataFrame:
            every = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
            short = every >> np.uint64(32 - bits)
            edges = np.searchsorted(short >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
            low = short.astype(np.uint32)
            rows = [(r, low[a:b].tobytes()) for r, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
            return pd.DataFrame(rows, columns=["range", "tokens"])

        for b in batches:
            for text in b["text"]:
                tokens = shingles(text)
                same = set_id(tokens)
                if same in seen:  # a copy of a text of this task
                    continue
                seen.add(same)
                held.append(tokens)
                n += len(tokens)
                if n >= GATHERED:
                    yield send()
                    held, n = [], 0
        yield send()

    def shared(g: pd.DataFrame) -> pd.DataFrame:
        every = np.sort(np.concatenate([np.frombuffer(t, np.uint32) for t in g["tokens"]]))
        again, last = np.unique(every[1:][every[1:] == every[:-1]]), COMMON - 1
        often = np.unique(every[last:][every[last:] == every[: len(every) - last]])
        return pd.DataFrame({"range": g["range"].iloc[:1], "n": len(again), "tokens": [again.tobytes()], "common": [often.tobytes()]})

    parts = docs.select("text").mapInPandas(gather, "range int, tokens binary")
    found = staged(parts.groupBy("range").applyInPandas(shared, "range int, n long, tokens binary, common binary"), "jaccard-shared")
    n = found.agg(F.sum("n")).first()[0] or 0
    size = min(BITMAP_BITS.bit_length() - 1, max(bits + 3, math.ceil(math.log2(max(8, BITS_A_TOKEN * n)))))

    def piece(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def packed(tokens: bytes) -> bytes:
            bit = np.zeros(1 << (size - bits), np.uint8)
            bit[np.frombuffer(tokens, np.uint32).astype(np.uint64) >> np.uint64(32 - (size - bits))] = 1
            return np.packbits(bit).tobytes()

        for b in batches:
            out = [(r, packed(t), packed(c)) for r, t, c in zip(b["range"], b["tokens"], b["common"])]
            yield pd.DataFrame(out, columns=["range", "bits", "common"])

    whole = np.zeros(1 << (size - 3), np.uint8), np.zeros(1 << (size - 3), np.uint8)
    step = 1 << (size - bits - 3)
    for r, *both in found.mapInPandas(piece, "range int, bits binary, common binary").collect():  # 2 x BITMAP_BITS / 8 bytes at most
        for out, b in zip(whole, both):
            out[r * step : (r + 1) * step] = np.frombuffer(b, np.uint8)
    return whole


def marked(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens >> np.uint64(64 - (len(bits).bit_length() + 2))
    return (bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1


def prefixes(tokens: np.ndarray, n: int, common: np.ndarray) -> list[np.ndarray]:
    """``tokens``: those not alone, of a set of ``n``. Their part of the prefix,
    under each order; those in ``common`` come last."""
    rest = n - needed(n) + 1 - (n - len(tokens))
    if rest <= 0:
        return [tokens[:0]] * ORDERS
    return [tokens[np.lexsort((mixed(tokens, k + 1), common))[:rest]] for k in range(ORDERS)]


def sets(docs: DataFrame, bits) -> DataFrame:
    """A row per text: ``doc_id, text_key, set_id, n``, and, once per task and set, if it
    may be similar to another: ``alone, tokens``, their last 32 bits (``short``; so
    many are ``hidden`` behind equal ones) and its prefixes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "set_id", "n", "alone", "tokens", "short", "hidden", *(f"p{k}" for k in range(ORDERS))]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, often = bits.value
        seen = set()
        for b in batches:
            out = []
            for doc_id, key, text in zip(b["doc_id"], b["text_key"], b["text"]):
                every = shingles(text)
                n, same = len(every), set_id(every)
                tokens = every[marked(known, every)]
                row = (doc_id, key, same, n, n - len(tokens))
                if not n or len(tokens) < needed(n) or same in seen:
                    out.append((*row, *[None] * (3 + ORDERS)))
                else:
                    first, *others = prefixes(tokens, n, marked(often, tokens))
                    short = np.unique(tokens.astype(np.uint32)).view(np.int32)
                    out.append((*row, tokens.view(np.int64), short, len(tokens) - len(short), first.view(np.int64), *(p.astype(np.uint32).view(np.int32) for p in others)))
                    seen.add(same)
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "object", "hidden": "Int32"})

    more = "".join(f", p{k} array<int>" for k in range(1, ORDERS))
    schema = f"doc_id {kind}, text_key long, set_id long, n long, alone long, tokens array<long>, short array<int>, hidden int, p0 array<long>{more}"
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInPandas(read, schema)


def to_share(n: Column, m: Column) -> Column:
    """The tokens that sets of these sizes share if they are similar, at least."""
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT))


def similar(shared: Column) -> Column:
    return 100 * shared >= PERCENT * (F.col("a_n") + F.col("b_n") - shared)


def verified(pairs: DataFrame, alive: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that are similar: first by the other orders' prefixes
    and short tokens, then by the tokens themselves."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-ids")
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    some = alive.join(ids, F.col("set_id") == F.col("id"), "left_semi")

    def both(pairs: DataFrame, columns: list[str]) -> DataFrame:
        side = lambda s: some.select(F.col("set_id").alias(f"{s}_set_id"), *(F.col(c).alias(f"{s}_{c}") for c in columns))
        return pairs.join(side("a"), F.col("a") == F.col("a_set_id")).join(side("b"), F.col("b") == F.col("b_set_id"))

    near = both(pairs, ["n", "alone", *(f"p{k}" for k in range(1, ORDERS))])
    least = to_share(F.col("a_n"), F.col("b_n"))
    prefix = lambda s, k: F.slice(f"{s}_p{k}", F.lit(1), F.greatest(F.lit(0), F.col(f"{s}_n") - least + 1 - F.col(f"{s}_alone")).cast("int"))
    for k in range(1, ORDERS):
        near = near.where(F.arrays_overlap(prefix("a", k), prefix("b", k)))
    near = staged(near.select("a", "b"), "jaccard-near")
    short = both(near, ["n", "short", "hidden"])
    most = F.size(F.array_intersect("a_short", "b_short")) + F.least("a_hidden", "b_hidden")
    close = staged(short.where(similar(most)).select("a", "b"), "jaccard-close")
    exact = F.size(F.array_intersect("a_tokens", "b_tokens"))
    found = staged(both(close, ["n", "tokens"]).where(similar(exact)).select("a", "b"), "jaccard-links")
    discard(pairs.sparkSession, close, near)
    return found


def links(alive: DataFrame) -> DataFrame:
    """Links ``a, b`` between sets whose components are those of all similar pairs."""
    spark: SparkSession = alive.sparkSession
    sizes = ["n", "alone", "place"]
    every_bucket = alive.select("set_id", "n", "alone", F.posexplode("p0").alias("place", "token")).withColumn("place", F.col("place") + F.col("alone"))
    every_bucket = staged(every_bucket, "jaccard-tokens")
    several = every_bucket.groupBy("token").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low < high").select("token")
    buckets = staged(every_bucket.join(several, "token"), "jaccard-buckets")
    discard(spark, every_bucket)

    rank = F.struct((F.col("alone") / F.col("n")).alias("share"), F.col("set_id").alias("id"), *sizes, "label")
    labelled, found, tried = buckets.withColumn("label", F.col("set_id")), [], []
    for turn in range(STARS):
        centres = labelled.groupBy("token").agg(F.min(rank).alias("c"))
        if turn:  # centres from those that aren't connected to the first one
            outside = labelled.join(centres.select("token", F.col("c.label").alias("main")), "token").where("label <> main")
            centres = outside.groupBy("token").agg(F.min(rank).alias("c"))
        centres = centres.select("token", F.col("c.share").alias("share"), *(F.col(f"c.{x}").alias(f"c_{x}") for x in ("id", *sizes, "label")))
        met = labelled.join(centres, "token").where((F.col("label") != F.col("c_label")) & fits("", "c_"))
        pairs = met.select("set_id", "c_id", "share", F.least("set_id", "c_id").alias("a"), F.greatest("set_id", "c_id").alias("b"))
        for t in tried:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        best = pairs.groupBy("set_id").agg(F.min(F.struct("share", "c_id", "a", "b")).alias("best")).select("best.a", "best.b")
        pairs = staged(best.distinct(), "jaccard-pairs")
        tried.append(pairs)
        found.append(verified(pairs, alive))
        roots = components(reduce(DataFrame.unionByName, found))
        before = labelled
        labelled = buckets.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("label", F.coalesce("root", "set_id")).drop("node", "root")
        open_ = labelled.groupBy("token").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1").select("token")
        labelled = staged(labelled.join(open_, "token"), "jaccard-open")
        discard(spark, *[before] * bool(turn))
        if labelled.isEmpty():
            break
    else:
        found.append(verified(unconnected(labelled), alive))
    return reduce(DataFrame.unionByName, found)


def unconnected(labelled: DataFrame) -> DataFrame:
    """All pairs ``a, b`` of a bucket with different labels that could share
    enough. A bucket of more than ``BLOCK_SETS`` sets is dealt to blocks; each
    of its sets goes to all blocks on one side and to its own on the other, so
    no task holds the bucket. Only ids and sizes move."""
    blocks = labelled.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    sides = labelled.join(blocks, "token")
    columns = ("set_id", "n", "alone", "place", "label")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    one = sides.select("token", *(F.col(c).alias(f"a_{c}") for c in columns), every.alias("block"))
    other = sides.select("token", *(F.col(c).alias(f"b_{c}") for c in columns), F.pmod(F.xxhash64("set_id"), "blocks").alias("block"))
    met = one.join(other, ["token", "block"]).where((F.col("a_set_id") < F.col("b_set_id")) & (F.col("a_label") != F.col("b_label")) & fits("a_", "b_"))
    return staged(met.select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b")).distinct(), "jaccard-pairs")


def fits(x: str, y: str) -> Column:
    """Two sets of a bucket could share enough, and the token is in both
    prefixes as this pair's sizes make them."""
    col = lambda side, name: F.col(f"{side}{name}")
    best = F.least(*(col(s, "n") - col(s, "alone") for s in (x, y)))
    least = to_share(col(x, "n"), col(y, "n"))
    return (best >= least) & (col(x, "place") <= col(x, "n") - least) & (col(y, "place") <= col(y, "n") - least)


def components_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n, root`` of every row: the size of its set and the
    set that names its component."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(bitmap(docs))
    discard(spark)
    read = staged(sets(docs, bits), "jaccard-sets")
    rows = staged(read.select("doc_id", "text_key", "set_id", "n"), "jaccard-ids")
    alive = staged(read.where("size(p0) > 0").drop("doc_id", "text_key").dropDuplicates(["set_id"]), "jaccard-alive")
    discard(spark, read)
    roots = components(links(alive))
    discard(spark, alive)
    named = rows.join(roots, F.col("set_id") == F.col("node"), "left")
    return named.select("doc_id", "text_key", "n", F.coalesce("root", "set_id").alias("root"))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``: the size
    of its set, and the smallest id reachable over similar pairs.

    ``docs`` needs ``doc_id, text``; other columns are ignored. A null or
    empty text, or one of blanks, has no shingles and is linked with nothing:
    its component is its own id. Links are between texts, so rows that repeat
    an id with another text aren't linked by the id. Null ids don't count
    towards the smallest id; a component of such rows alone has a null id. No
    rows give no rows.
    """
    named = components_of(docs)
    least = named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "of")
    out = named.join(least, (F.col("root") == F.col("of")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row
    stays, the one with the smallest id (null last), then by its text's hash.

    ``docs`` needs ``doc_id, text`` and keeps all its columns, whatever their
    names. Components are of texts: rows that repeat an id with unlike texts
    all stay, and rows without an id are compared like others. Of rows with
    equal id and text one stays, the first by a hash of the row. Null and
    empty texts, and those of blanks, have no shingles and all stay. No rows
    give no rows. The texts are shuffled once, by id.
    """
    named = components_of(docs).where("n > 0")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    keep = first.select(F.col("first.doc_id").alias("keep_id"), F.col("first.text_key").alias("keep_key"))
    nested = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    blank = F.length(F.translate(F.coalesce("row.text", F.lit("")), ASCII_BLANKS, "")) == 0
    plain = [f"row.`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    found = nested.where(~blank).join(keep, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key")))
    one = Window.partitionBy("id", "key").orderBy(F.xxhash64(*plain))
    kept = found.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row.*")
    return kept.unionByName(nested.where(blank).select("row.*"))


def op7_jaccard(spark, sf_dir) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:least(i + 4, len(w))], ' ')) AS t FROM places),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.y FROM reach r JOIN both_ways l ON l.x = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
