"""Operators on texts: mixing, token counts, encoding, quality rules, toxicity, Jaccard join."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clinistar.llm import bpe, jaccard, merges, mix, quality, token_count, toxicity
from clinistar.llm.common import table

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, SIZE long, Token string, label int"
SF = "/root/testdata/sf0.001"


def rows(*pairs, source="s"):
    return [(i, t, "en", source, len(t or ""), 5, "x", 1) for i, t in pairs]


def docs(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank, very long, tied and repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 997} x{i}" for i in range(60_000))
    return docs(spark, [
        *rows((1, "a b c d e f g"), (1, "a b c d e f g"), (2, ""), (3, None), (4, " \t\n "), (None, "a b c d e f g"), (5, long), (6, "q" * 100_000), (7, "one two")),
        (8, "a b c d e f g", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
    ]).cache()


# --- 1 -------------------------------------------------------------------
def brute_targets(sizes: dict, weights=mix.WEIGHTS, most=mix.MAX_EPOCHS):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        t = {s: w[s] * free / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if t[s] > most * sizes[s]]
        if not over:
            return t | {s: most * sizes[s] for s in capped}
        capped |= set(over)


def test_mix_meets_targets_exactly(spark):
    rng = random.Random(3)
    data = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", rng.choice(["big"] * 12 + ["b", "c", "é", "z", None]), 0, 0, "", 0) for i in range(600)]
    got = mix.mix(docs(spark, data)).collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = brute_targets(sizes)
    for s, target in want.items():
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 0.5
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    again = mix.mix(docs(spark, data[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_mix_odd_rows(spark, odd):
    got = mix.mix(odd)
    assert got.count() == odd.count()
    assert {r["source"] for r in got.select("source").distinct().collect()} == {"s", None}
    assert all(r.taken == 0 for r in got.where("size = 0").collect())
    assert mix.mix(odd.limit(0)).count() == 0
    assert mix.mix(odd.where("text is null")).agg(F.sum("taken")).first()[0] == 0


def test_mixed_documents_are_whole_and_near_the_targets(spark):
    rng = random.Random(5)
    data = [(i, " ".join(f"w{i}" for _ in range(rng.randrange(1, 30))), "en", rng.choice("aab"), 1, 2, "t", 3) for i in range(400)]
    d = docs(spark, data)
    out = mix.mixed_documents(d)
    assert out.columns == d.columns
    whole = {r[0]: r[1] for r in data}
    taken = {}
    for r in out.collect():
        assert r.text == whole[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    targets = {r.source: r.target for r in mix.mix(d).collect()}
    assert all(-1 <= taken[s] - targets[s] <= 30 for s in targets)


# --- 2, 3 ----------------------------------------------------------------
PIECES = ["a", "e", "Σ", "İ", "ß", " ", "  ", "\n", "\xa0", "\x1c", "\x85", "　", "é", "日", "1", "²", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "😀", "the", "ing", "!!", "\x00", "՘"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=50).map("".join))
def test_tokens_are_the_librarys(text):
    assert token_count.counter(BYTE).count(text) == len(LIBRARY[BYTE].encode(text, add_special_tokens=False).ids)
    ids = LIBRARY[WORD].encode(text, add_special_tokens=False).ids
    assert bpe.encoder(WORD).ids(text) == ids
    n, ids_digest, text_digest = bpe.encode_digests(text, WORD)
    assert n == len(ids) and ids_digest == hashlib.sha256(merges.pack(ids)).hexdigest()
    decoded = LIBRARY[WORD].decode(ids, skip_special_tokens=False)
    assert text_digest == hashlib.sha256(decoded.encode()).hexdigest()
    assert "".join(bpe.decoder(WORD).joined(iter(ids))) == decoded


def test_decoded_digest_is_of_the_emitted_ids(monkeypatch):
    text = "the cat <|endoftext|> sat on größe 日本 " * 9
    ids = bpe.encoder(WORD).ids(text)
    right = bpe.encode_digests(text, WORD)
    monkeypatch.setattr(bpe, "GROUP", 4)  # the decoder's state goes on from group to group
    assert bpe.encode_digests(text, WORD) == right
    wrong = [*ids[:-1], ids[0]]
    pieces = bpe.Encoder.pieces

    def one_wrong(self, t):
        *first, last = pieces(self, t)
        yield from first
        yield last[:-4] + merges.pack([ids[0]])

    monkeypatch.setattr(bpe.Encoder, "pieces", one_wrong)
    decoded = LIBRARY[WORD].decode(wrong, skip_special_tokens=False)
    assert bpe.encode_digests(text, WORD) == (len(ids), hashlib.sha256(merges.pack(wrong)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def test_whole_tokens_are_proved():
    whole = merges.load(BYTE).whole()
    ids = {t: LIBRARY[BYTE].encode(t, add_special_tokens=False).ids for t in random.Random(1).sample(sorted(whole), 500) if t.strip()}
    assert all(len(merges.load(BYTE).merge(merges.load(BYTE).symbols(t))) == 1 for t in ids)
    assert len(whole) < len(merges.load(BYTE).ids)  # some strings of the vocabulary don't encode alone as one token


def test_transducer_streams_with_its_lookahead():
    small = bpe.Encoder(WORD, block=8)
    rng = random.Random(2)
    for word in ["ab" * 2000, "a" * 3000, *("".join(rng.choices("abcdehinrst", k=1500)) for _ in range(20))]:
        assert [small.merges.ids[t] for t in small.tokens(word)] == LIBRARY[WORD].encode(word, add_special_tokens=False).ids
    assert small.lookahead == merges.load(WORD).lookahead() < 1000


def test_decoder_gives_words_back():
    text = "größe 日本 naïve 😀 x1"
    ids = bpe.encoder(WORD).ids(text)
    assert "".join(bpe.decoder(WORD).text(iter(ids))).split() == "größe 日本 naïve 😀 x 1".split()


def test_counts_and_encoding_odd_rows(spark, odd):
    counts = token_count.token_counts(odd, BYTE).collect()
    texts = odd.select("doc_id", "text").collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(LIBRARY[BYTE].encode(r.text or "", add_special_tokens=False).ids)) for r in texts)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in counts) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in counts)
    got = bpe.encode_documents(odd, WORD).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((r.doc_id or -1, len(LIBRARY[WORD].encode(r.text or "", add_special_tokens=False).ids)) for r in texts)
    assert token_count.token_counts(odd.limit(0), BYTE).count() == bpe.encode_documents(odd.limit(0), WORD).count() == 0


# --- 7 -------------------------------------------------------------------
def brute_groups(data):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(t):
        w = (t or "").translate(lower).encode().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in data]
    label = list(range(len(data)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                label[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted(((d is None, d or 0, len(sets[i]), (ids.get(find(i)) if sets[i] else d) or 0) for i, (d, _) in enumerate(data)))


def test_jaccard_groups_equal_brute_force(spark):
    rng = random.Random(11)
    words = [f"v{i}" for i in range(400)]
    common = " ".join(rng.choices(words, k=12))
    data = []
    for g in range(25):
        base = rng.choices(words, k=rng.randrange(3, 150))
        for _ in range(rng.choice([1, 1, 2, 9])):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(words)
            data.append((len(data) * 3 + 1, " ".join(text) + (" " + common if g % 3 == 0 else "")))
    hub = rng.choices(words, k=120)  # a family in which most pairs aren't similar
    for i in range(60):
        text = list(hub)
        for k in range(rng.randrange(0, 7)):
            text[rng.randrange(len(text))] = f"own{i}_{k}" if k % 2 else rng.choice(words)
        data.append((len(data) * 3 + 1, " ".join(text)))
    data += [(2, None), (3, ""), (4, "  \n"), (None, data[0][1]), (None, "only here and not elsewhere at all"), (1, "another text with the id of the first"), (5, "A b"), (6, "a  B"), (6, "a  B")]
    rng.shuffle(data)
    d = docs(spark, rows(*data))
    got = jaccard.groups(d).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got)) == brute_groups(data)
    kept = jaccard.one_of_each(d)
    assert kept.columns == d.columns
    ids = [r.doc_id for r in kept.collect() if (r.text or "").strip()]
    assert set(ids) - {None} == {r.component_id for r in got if r.component_id is not None and r.n_shingles > 0}
    assert ids.count(None) == 1  # the text that has no id and no copy with one


def test_jaccard_full_bitmap_changes_nothing(spark, monkeypatch):
    base = "the quick brown fox jumps over the lazy dog and runs far away from the old red barn".split()
    data = [(i, " ".join(base[: 14 + i % 3] + [f"t{i}"] * (i % 2))) for i in range(12)] + [(50 + i, f"text {i} " * 8) for i in range(10)]
    monkeypatch.setattr(jaccard, "BITMAP_BITS", 8)
    got = jaccard.groups(docs(spark, rows(*data))).collect()
    assert sorted(((False, r.doc_id, r.n_shingles, r.component_id) for r in got)) == brute_groups(data)


def test_jaccard_empty_table(spark, odd):
    assert jaccard.groups(odd.limit(0)).count() == 0
    assert jaccard.one_of_each(odd.limit(0)).count() == 0


def test_jaccard_large_buckets_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard, "COMMON", 4)
    monkeypatch.setattr(jaccard, "STARS", 0)  # all pairs of a bucket are candidates
    rng = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    data = []
    for i in range(40):
        text = list(base)
        for k in range(rng.randrange(0, 8)):
            text[rng.randrange(60)] = f"c{rng.randrange(6)}"
        data.append((i, " ".join(text)))
    got = jaccard.groups(docs(spark, rows(*data))).collect()
    assert sorted(((False, r.doc_id, r.n_shingles, r.component_id) for r in got)) == brute_groups(data)


CLASHES = "keep_id int, keep_key int, keep_nth int, row int, id int, key int, nth int, root int, n int, passes int, cut int, mix_pass int, mix_source int, size int"


def clashing(spark, data):
    """``doc_id, text`` with columns named like those the stages use inside."""
    n = CLASHES.count(",") + 1
    return spark.createDataFrame([(d, t, "s", *range(k, k + n)) for k, (d, t) in enumerate(data)], f"doc_id long, text string, source string, {CLASHES}")


def test_one_of_each_loses_no_unlike_text(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    data = [(1, x), (1, z), (2, x), (3, y), (None, y), (None, "v " + z), (None, "lone text without any id or copy"), (4, None), (4, ""), (5, " "), (1, x)]
    d = clashing(spark, data)
    kept = jaccard.one_of_each(d)
    assert kept.columns == d.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, x), (1, z), (3, y), (None, "lone text without any id or copy"), (4, None), (4, ""), (5, " ")], key=repr)
    before = {tuple(r) for r in d.collect()}
    assert all(tuple(r) in before for r in kept.collect())  # no column is overwritten


def test_mixed_documents_keep_clashing_columns(spark):
    d = clashing(spark, [(k, "a b c " * (k + 1)) for k in range(20)] + [(None, "a b"), (3, None)])
    mixed = mix.mixed_documents(d, weights=(1,), max_epochs=3)
    assert mixed.columns == d.columns
    before = {tuple(r) for r in d.collect()}
    assert mixed.count() == 21 and all(tuple(r) in before for r in mixed.collect())


# --- 8 -------------------------------------------------------------------
def brute_repeats(text, k=8):
    w = (text or "").encode().split()
    seen = {}
    for i in range(len(w) - k + 1):
        seen.setdefault(tuple(w[i : i + k]), []).append(i)
    return len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + k)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_repeated_words(words):
    assert quality.repeated_words(" ".join(words)) == brute_repeats(" ".join(words))


def test_quality_statistics_and_verdicts(spark, odd):
    labels = table(spark, SF, "labels")
    got = quality.quality(odd, labels)
    assert got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect()}
    assert (by[3].n_words, by[3].word_chars, by[3].base_failed, by[3].kept) == (0, 0, True, False)
    assert by[5].n_words == 120_000 and by[5].n_repeat_words == 0 and not by[5].base_failed
    assert by[6].word_chars == 100_000
    lines = docs(spark, rows((1, "a b\n\n a b\na b\n#x$ é\n" * 2)))
    r = quality.with_statistics(lines).first()
    text = "a b\n\n a b\na b\n#x$ é\n" * 2
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (16, 20, 4, 5)
    assert r.n_repeat_words == brute_repeats(text)
    assert quality.quality(odd.limit(0), labels).count() == 0


def test_quality_keeps_good_and_drops_bad(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    got = quality.quality(table(spark, sf, "documents"), labels).where("not base_failed").join(labels, "doc_id")
    rates = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.99 and rates[0] < 0.1


def test_quality_without_labels_only_applies_base_rules(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality(table(spark, SF, "documents"), labels)
    assert got.where("kept = base_failed").count() == 0


# --- 9 -------------------------------------------------------------------
def test_grammar_kinds():
    m = toxicity.Model({"idiot": 5.0, "loweb*": 4.0})
    kind = lambda text: [k for k, x in zip(toxicity.KINDS, m.features(text)) if x]
    assert kind("What an idiot.") == ["insult"]
    assert kind("You are an idiot.") == ["insult", "insult at a target"]
    assert kind("He is not an idiot.") == ["negated insult"]
    assert kind("Not today, as we all know well, an idiot came.") == ["insult", "insult at a target"]
    assert kind("She said what an idiot.") == ["reported insult"]
    assert kind("She left. An idiot. We said so.") == ["insult"]
    assert kind("I will kill you") == ["threat"]
    assert kind("die lowebande") == ["insult"]
    assert kind("") == kind(None) == kind("a fine day") == []


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    got = toxicity.toxicity(table(spark, sf, "documents"), labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    caught = sum(r.predicted for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.predicted for r in held if not r.toxic) / sum(not r.toxic for r in held)
    assert caught > 0.75 and wrong < 0.02


def test_toxicity_never_learns_held_out_labels(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(d, labels), toxicity.learn(d, flipped)
    assert a.patterns == b.patterns and a.weights == b.weights


def test_toxicity_odd_rows(spark, odd):
    labels = table(spark, SF, "labels")
    got = toxicity.toxicity(odd, labels.unionByName(spark.createDataFrame([(None, None, None), (1, 1, 1), (1, 1, 0)], labels.schema)))
    assert got.count() == odd.count()
    assert got.where("score is null or predicted is null or held_out is null").count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert toxicity.toxicity(odd, none).agg(F.max("predicted")).first()[0] == 0
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0
