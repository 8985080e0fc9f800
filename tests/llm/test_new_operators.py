"""Fingerprints, phrases and tokenizer alignment against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from clinistar.llm import align, merges, phrases, simhash

SCHEMA = "doc_id long, text string, lang string, fp string, chunk int, id string, node int, place int, f int, a int"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, rows):
    """``rows``: doc_id, text, lang; and columns that the operators use inside."""
    return spark.createDataFrame([(d, t, g, "x", 1, "y", 2, 3, 4, 5) for d, t, g in rows], SCHEMA).repartition(3)


def prose(seed, n, vocabulary=40):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


ODD = [(1, None, "en"), (2, "", None), (3, " \t\n", "en"), (4, "One", None), (5, "one two", "de"), (None, "one two", "de"),
       (6, "x " * 70_000, "en"), (6, "x " * 70_000, "en"), (7, "Ünï cödé ﬁ ▁   Á 😀\r\n;\r <|endoftext|> </s>", "en"), (None, None, None)]


# --- 11 --------------------------------------------------------------------
def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """By ``(doc_id, fingerprint)``: the smallest id reachable."""
    left, out = set(range(len(rows))), {}
    while left:
        todo = group = {left.pop()}
        while todo:
            todo = {j for j in left for i in todo if (rows[i][1] ^ rows[j][1]).bit_count() <= 3}
            left, group = left - todo, group | todo
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out |= {i: min(ids, default=None) for i in group}
    return Counter((rows[i][0], f"{rows[i][1]:016x}", c) for i, c in out.items())


@pytest.mark.parametrize("largest", [1, 32])
def test_simhash_equals_brute_force(spark, monkeypatch, largest):
    monkeypatch.setattr(simhash, "LARGEST", largest)  # 1: buckets are divided down to the last level
    rows = [(100 + k, prose(k, 300), "en") for k in range(12)]
    rng = random.Random(1)
    for k in range(150):  # copies with a few words changed
        words = rows[k % 12][1].split()
        for _ in range(k % 3):
            words[rng.randrange(300)] = f"new{k}"
        rows.append((200 + k, " ".join(words), "en"))
    rows += [(d, t, g) for d, t, g in ODD if t is None or len(t) < 1000]
    got = Counter(tuple(r) for r in simhash.groups(frame(spark, rows)).collect())
    assert got == brute_components([(d, brute_fingerprint(t)) for d, t, _ in rows])
    assert simhash.groups(frame(spark, ODD).limit(0)).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = prose(3, 500)
    want = brute_fingerprint(text)
    for n in (1, 7, 498, 499):
        monkeypatch.setattr(simhash, "AT_ONCE", n)
        assert simhash.fingerprint(text) == want


def test_every_allocation_finds_all_within_tau():
    parts = [[0, 5, 9], [1, 2, 3, 4], [6, 7, 8]]
    bits = sorted(itertools.chain(*parts))
    for thresholds in itertools.product(range(-1, 4), repeat=3):
        if sum(thresholds) == simhash.TAU - len(parts) + 1:
            probes = [{simhash.mask_of(f) for d in range(t + 1) for f in itertools.combinations(p, d)} for p, t in zip(parts, thresholds)]
            for d in range(simhash.TAU + 1):
                for flip in itertools.combinations(bits, d):
                    assert any(simhash.mask_of(b for b in flip if b in p) in found for p, found in zip(parts, probes))
    for left in range(simhash.TAU + 1):
        assert sum(simhash.divided(left)) == left - 1


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(0)
    costs = [rng.random((40, simhash.TAU + 1)).cumsum(axis=1) * 10 for _ in range(3)]
    codes = simhash.allocate(costs)
    for row, code in enumerate(codes):
        digits = [int(code) // 5**i % 5 for i in range(3)]
        cost = lambda us: sum(c[row, u - 1] if u else 0 for c, u in zip(costs, us))
        every = [us for us in itertools.product(range(5), repeat=3) if sum(us) == simhash.TAU + 1]
        assert sum(digits) == simhash.TAU + 1 and abs(cost(digits) - min(map(cost, every))) < 1e-9


def test_shells_count_by_distance():
    h = np.random.default_rng(2).integers(0, 5, 256).astype(float)
    got = simhash.shells(h)
    for v in (0, 17, 255):
        assert list(got[v]) == [sum(h[w] for w in range(256) if (v ^ w).bit_count() == d) for d in range(4)]


def test_correlated_bits_share_a_part():
    corr = np.zeros((8, 8))
    for a, b in ((0, 7), (1, 6), (0, 3), (7, 3)):
        corr[a, b] = corr[b, a] = 0.9
    parts = simhash.grouped(list(range(8)), (4, 4), corr)
    assert {0, 3, 7} <= set(parts[0]) and sorted(parts[0] + parts[1]) == list(range(8))


# --- 12 --------------------------------------------------------------------
def brute_phrases(rows, least, top, longest=3):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in "".join("\n" if c in ".,;:!?\n\x0b\x0c\r" else c for c in low).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        around = [b for (g, q), b in found.items() if g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if not any(100 * b >= 50 * a for b in around):
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out.sort()
    rows = []
    for lang, own in itertools.groupby(out, key=lambda r: r[0]):
        rows += [(lang, r + 1, p.decode(), -a, lf, rf, n[lang], -s) for r, (_, s, a, p, lf, rf) in enumerate(itertools.islice(own, top))]
    return sorted(rows)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_equal_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(phrases, "CHUNK", 300)
    monkeypatch.setattr(phrases, "TILE", 4)
    monkeypatch.setattr(phrases, "HEAD", 9)  # most phrases are joined
    rows = [(k, prose(k, 120, 14).replace(" w3 ", ", ").replace(" w5", " W5\t"), random.Random(k).choice(["en", "de", None])) for k in range(40)]
    rows += [(900 + k, "new york city. New  York\tcity! São Paulo", "en") for k in range(12)] + [(950, "a b c a b c a b c", "fr")] * 5 + ODD
    got = phrases.collocations(frame(spark, rows), max_words=longest, least=5, top=60)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 5, 60, longest)
    assert phrases.collocations(frame(spark, rows).limit(0)).count() == 0


def test_dense_and_sparse_tiles_count_alike(monkeypatch):
    rng = np.random.default_rng(5)
    left, right = (rng.zipf(1.3, 20_000) % 5000 for _ in range(2))
    want = np.unique(left << 32 | right, return_counts=True)
    for tile in (8, 64, 1024):
        monkeypatch.setattr(phrases, "TILE", tile)
        codes, counts = phrases.counted(left, right)
        assert (codes == want[0]).all() and (counts == want[1]).all()
    assert len(phrases.counted(left[:0], right[:0])[0]) == 0


def test_scores_beyond_64_bits_are_exact(spark):
    rng = random.Random(6)
    data = [(a := rng.randrange(10, 10**14), a + rng.randrange(10**6), a + rng.randrange(10**14)) for _ in range(200)] + [(10**15 - 1,) * 3]
    got = spark.createDataFrame(data, "a long, l long, r long").selectExpr("a", "l", "r", f"{phrases.SCORE} AS score").collect()
    assert all(r["score"] == 1_000_000 * r["a"] ** 2 // (r["l"] * r["r"]) for r in got)


# --- 13 --------------------------------------------------------------------
def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(PATHS[0])
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte = {c: k for k, c in enumerate(merges.byte_letters())}
    piece = lambda k: bytes([int(b_lib.id_to_piece(k)[3:5], 16)]) if b_lib.is_byte(k) else b_lib.id_to_piece(k).replace("▁", " ").encode()
    spans = lambda parts: list(itertools.pairwise(itertools.accumulate(map(len, parts), initial=0)))
    read, held = [], Counter()
    for doc_id, text, _ in rows:
        a, b, links, groups = [], [], [], []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            parts_a, parts_b = [bytes(byte[c] for c in a_lib.id_to_token(k)) for k in a], [piece(k) for k in b]
            if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
                a, b = [], []
            else:
                of_a, of_b = spans(parts_a), spans(parts_b)
                ends, low = sorted({e for _, e in of_a} & {e for _, e in of_b}), 0
                at = 0
                for i, (s, e) in enumerate(of_a):
                    while of_b[at][1] <= s:
                        at += 1
                    for j in range(at, len(of_b)):
                        if of_b[j][0] >= e:
                            break
                        links.append((a[i], b[j]))
                i = j = 0
                for end in ends:
                    group = ([], [])
                    while i < len(a) and of_a[i][1] <= end:
                        group[0].append(str(a[i]))
                        i += 1
                    while j < len(b) and of_b[j][1] <= end:
                        group[1].append(str(b[j]))
                        j += 1
                    groups.append("|".join(map(",".join, group)))
        held.update(set(links))
        read.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return Counter((d, na, nb, ng, len(ls), sum(held[k] == most[k[0]] for k in ls), sum(held[k] for k in ls), g) for d, na, nb, ng, ls, g in read)


TRICKY = ["a b", " a", "a ", "  a   b  ", "\na\n b\n\n c", "a\r\n b;\r c \r", "\t\t x　y  z", "x\x00y\x1f\x85z", "don't we'll  I'M 's", "naïve façade", "日本語 テキスト", "a▁b",
          "😀😀 👩‍👩‍👧", "12345 3.14 0x1F", "<0x0A> <s> <unk> <|endoftext|>", "﻿bom", "́a é", "\n", " ", "\r", "a \n", "; \r;\r\r \r"]


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", 200)
    rows = [(k, t, "en") for k, t in enumerate(TRICKY)] + [(100 + k, prose(k, 200, 300) + " Größe, señor;\r\n" * (k % 3), "en") for k in range(20)] + ODD
    got = Counter(tuple(r) for r in align.align(frame(spark, rows), *PATHS).collect())
    assert got == brute_alignment(rows)
    assert align.align(frame(spark, rows).limit(0), *PATHS).count() == 0


def test_words_are_encoded_as_in_the_whole_text(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 50)
    lib = align.Pair(*PATHS)
    assert lib.a.inner == set() and lib.b.inner == {"\r"}
    rng = random.Random(9)
    letters = [" ", " ", "\n", "\r", "\t", " ", "　", "a", "b", ";", "'s", "é", "9", "日", "{", "}", "//"]
    texts = TRICKY + ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(3000)]
    for text, (a, b) in zip(texts, lib.encode(texts)):
        want = lib.a.of([f" {text}"])[0], lib.b.of([f" {text}"])[0]
        if "▁" in text:
            want = [], []
        assert (a.tolist(), b.tolist()) == want, text


def test_a_word_is_walked_once(monkeypatch):
    walked, walk = [], align.aligned
    monkeypatch.setattr(align, "aligned", lambda a, b: walked.append(len(a)) or walk(a, b))
    long = "x" * (align.REMEMBERED_CHARS + 1)
    texts = [prose(k, 300, 40) for k in range(6)] + [f"{long} {long}", "a\u2581b w1", "", None]
    lib = align.Pair(*PATHS)
    once = [(links.tolist(), groups) for _, (links, groups) in zip(texts, lib.read(texts))]  # the last one isn't asked for more
    used = {w for t in texts if t for w in lib.words(f" {t}")}
    assert sum(walked) == sum(len(lib.a.of([w])[0]) for w in used if "\u2581" not in w)
    walked.clear()
    assert [(links.tolist(), groups) for links, groups in lib.read(texts)] == once
    assert sum(walked) == len(lib.a.of([f" {long}"])[0]), "only words that are too long are forgotten"
    assert all(got == ([], b"") for got in once[-3:]) and not any(got == ([], b"") for got in once[:-3])


def test_runs_are_skipped_wherever_they_end():
    rng = random.Random(4)
    for _ in range(300):
        both = sorted(rng.sample(range(1, 400), rng.randrange(1, 200)))
        last = max(both) + 1
        ends = [sorted({*(e for e in both if rng.random() < p), *rng.sample(range(1, last), min(last - 1, rng.randrange(4))), last}) for p in (0.95, 0.98)]
        stretches = align.aligned(*ends)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        got = [ends[0][i + k] for i, i_end, _, _, single in stretches for k in (range(i_end - i) if single else [i_end - i - 1])]
        assert got == cuts
        starts = [[0, *e[:-1]] for e in ends]
        pairs = [(i, j) for i, (s, e) in enumerate(zip(starts[0], ends[0])) for j, (u, v) in enumerate(zip(starts[1], ends[1])) if s < v and u < e]
        got = []
        for i, i_end, j, j_end, single in stretches:
            rise = [b"\1" * (i_end - i)] * 2 if single else align.rises(ends[0][i:i_end], ends[1][j:j_end])
            got += zip(*(list(itertools.accumulate(r, initial=k - 1))[1:] for r, k in zip(rise, (i, j))))
        assert got == pairs
