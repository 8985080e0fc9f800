"""Operator 13: alignment of two tokenizers by diagonal run skipping.

Two tokenizers cut the same bytes; where a token of each ends at the same
byte, a group ends. Mostly the groups are one token each, so with i tokens of
A and j of B read, the arrays of ends go on equally at the present shift
``j - i``. The walk compares slices of both at that shift, twice as long each
time they are equal (exponential probing), and so jumps the whole stretch. At
the first difference it steps the side that is behind until both ends meet:
that is an irregular group, after which the shift is a new one.

Both tokenizers encode the words of a text alone, and where a word ends a token
of each ends. A word's groups are therefore the same wherever it stands: the
walk goes over the new words of a batch, one behind the other, and what it finds
is remembered per word. A text's groups and links are those of its words.

How many documents of the corpus link a pair of ids, and whether that is the
most of its A id, needs all documents. Documents are therefore put into chunks
of bounded size, and only a chunk's distinct pairs are counted and joined, not
those of each document:

1. a chunk is a list of its distinct pairs, with how many of its documents
   hold each, and per document the places in that list;
2. the lists are added up to a row per pair, with the most per A id;
3. the lists are joined with that, and go back to their chunk as a whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinistar.llm import merges
from clinistar.llm.common import staged, table

#: Distinct pairs of the documents of a chunk together, about; a longer document is a chunk.
CHUNK = 1 << 21
#: Words (and one-to-one groups) that are remembered, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 1 << 19, 256
#: Words that are encoded together.
TOGETHER = 512
#: What stands for a space in sentence pieces (fixed value of that kind of vocabulary).
SPACE = "\u2581"
#: In a link ``a_id << 32 | b_id``: the first of its A token (sign bit), the first of its B token.
FIRST_A, FIRST_B = -1 << 63, 1 << 31
#: Put before a word that doesn't start with a space: no merge joins it to white space.
START = "\n"


# --- tokens ------------------------------------------------------------------
class Tokens:
    """Ids to bytes, lengths and decimal strings. ``of`` encodes many words,
    each alone. ``inner`` is the white space before which a text can't be cut,
    None if it can't be cut at all."""

    def __init__(self, pieces: list[bytes], of: Callable[[list[str]], list[list[int]]], inner: set[str] | None):
        self.bytes, self.of, self.inner = pieces, of, inner
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.decimal = [str(k) for k in range(len(pieces))]

    def encode(self, words: list[str], utf8: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, how many each has, and whether they give its
        bytes (``utf8``) back. Words that may stand one behind the other are
        encoded together, which costs less, and cut by their bytes: where a
        token ends with the word, no merge has crossed."""
        whole, word_ends = b"".join(utf8), np.cumsum(list(map(len, utf8)))
        if self.inner is not None:
            joined = self.of(["".join(words)])[0]
            ids = np.array(joined, np.int32)
            cuts = np.searchsorted(self.length[ids].cumsum(), word_ends, "right")
            if self.back(joined, ids, cuts, whole, word_ends):
                return ids, np.diff(cuts, prepend=0), np.ones(len(words), bool)
        each = self.of(words)  # or a word doesn't come back, or stands only at the end of a text
        joined, counts = list(chain.from_iterable(each)), np.array(list(map(len, each)), np.int64)
        ids = np.array(joined, np.int32)
        if self.back(joined, ids, counts.cumsum(), whole, word_ends):
            return ids, counts, np.ones(len(words), bool)
        return ids, counts, np.array([b"".join(map(self.bytes.__getitem__, got)) == want for want, got in zip(utf8, each)], bool)

    def back(self, joined: list[int], ids: np.ndarray, cuts: np.ndarray, whole: bytes, word_ends: np.ndarray) -> bool:
        """Whether the ids, cut there, give each word's bytes."""
        return b"".join(map(self.bytes.__getitem__, joined)) == whole and bool((self.length[ids].cumsum()[cuts - 1] == word_ends).all())


def byte_level(path: str) -> Tokens:
    """A byte-level vocabulary. Its pattern cuts texts into pre-tokens, and only
    at the start of one is white space before other characters: where white
    space follows another character, a pre-token starts."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has its core
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    lib.no_truncation()
    lib.no_padding()
    byte = {letter: k for k, letter in enumerate(merges.byte_letters())}
    names = [lib.id_to_token(k) or "" for k in range(lib.get_vocab_size())]
    pieces = [bytes([byte[c] for c in t]) if all(c in byte for c in t) else t.encode() for t in names]
    return Tokens(pieces, lambda words: [e.ids for e in lib.encode_batch_fast(words, add_special_tokens=False)], set() if lib.normalizer is None else None)


def sentence_pieces(path: str) -> Tokens:
    """Sentence pieces are merged over the whole text, after a space is put
    before it. No merge crosses the place before white space that no piece has
    after another character; without a normaliser, what stands between such
    places can be encoded alone."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [lib.id_to_piece(k) for k in range(lib.get_piece_size())]
    pieces = [bytes([int(t[3:5], 16)]) if lib.is_byte(k) else t.replace(SPACE, " ").encode() for k, t in enumerate(names)]
    inner = {c for t in names if len(t) > 1 for c in re.findall(rf"[{SPACE}{merges.SPACE}]", t.lstrip(SPACE)[t[:1] != SPACE :])}
    sample = "a  \u00a0 \ufb01 \u0041\u0301  "
    plain = b"".join(pieces[k] for k in lib.encode(sample)) == f" {sample}".encode() and SPACE not in inner
    space = lib.piece_to_id(SPACE)

    def of(words: list[str]) -> list[list[int]]:
        """The library puts the space before a word. One that doesn't start
        with a space gets another start, which is taken off again."""
        spaced = [w[1:] if w[:1] == " " else START + w for w in words]
        return [([space] if not t else ids) if w[:1] == " " else ids[len(start) :] for w, t, ids in zip(words, spaced, lib.encode(spaced, num_threads=1))]

    start = lib.encode(START)
    return Tokens(pieces, of, inner if plain and START not in inner else None)


def words(*inner: set[str] | None) -> Callable[[str], list[str]]:
    """Cuts a text where white space follows another character, but not before
    ``inner`` white space, so that each tokenizer can encode the words alone."""
    if None in inner:
        return lambda text: [text]
    space, more = merges.SPACE, "".join(map(re.escape, sorted(set().union(*inner))))
    return re.compile(rf"[{space}]*[^{space}]+" + (rf"(?:[{more}][{space}]*[^{space}]*)*" if more else "") + rf"|[{space}]+").findall


class Pair:
    """Both tokenizers, and the groups of the words they were given, in a
    dictionary of bounded size."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), sentence_pieces(path_b)
        self.words = words(self.a.inner, self.b.inner)
        #: Per word its links and the text of its groups, packed. One whose tokens don't give it back isn't kept.
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def read(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, bytes]]:
        """The links of each text with a space before it, marked as ``linked``
        does, and the text of its groups; none if its tokens don't give its
        bytes back."""
        cut = [self.words(f" {t}") if t else [] for t in texts]
        found = [list(map(self.known.get, words)) for words in cut]
        new = list({w for words, got in zip(cut, found) for w, g in zip(words, got) if g is None})
        new.sort(key=str.isspace)  # white space alone ends a text: nothing may stand behind it
        fresh: dict[str, tuple[bytes, bytes] | None] = {}
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            fresh.update(zip(some, self.aligned_words(some)))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known = {w: g for words, got in zip(cut, found) for w, g in zip(words, got) if g}
        if len(self.known) + len(fresh) <= REMEMBERED:  # before any yield: a caller may not ask for more than it needs
            self.known.update((w, g) for w, g in fresh.items() if g and len(w) <= REMEMBERED_CHARS)
        for words, got in zip(cut, found):
            got = [g or fresh[w] for w, g in zip(words, got)]
            if not got or None in got:
                yield np.empty(0, np.int64), b""
            else:
                links, groups = zip(*got)
                yield np.frombuffer(b"".join(links), np.int64), b";".join(groups)

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text with a space before it; none if they don't give its bytes back."""
        for links, _ in self.read(texts):
            ids_a, ids_b = (links >> 32 & 0x7FFFFFFF).astype(np.int32), (links & 0x7FFFFFFF).astype(np.int32)
            yield ids_a[links < 0], ids_b[links & FIRST_B != 0]

    def aligned_words(self, words: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """The links and the groups' text of each word, by one walk over all."""
        utf8 = [w.encode("utf-8", "replace") for w in words]
        (ids_a, n_a, back_a), (ids_b, n_b, back_b) = self.a.encode(words, utf8), self.b.encode(words, utf8)
        back = back_a & back_b
        if not back.all():
            ids_a, ids_b = ids_a[np.repeat(back, n_a)], ids_b[np.repeat(back, n_b)]
        links, groups = linked(ids_a, ids_b, self.a, self.b)
        first_a, starts = links < 0, np.cumsum(n_a[back]) - n_a[back]
        at = np.append(np.flatnonzero(first_a)[starts], len(links))
        group = np.append(0, np.cumsum(first_a & (links & FIRST_B != 0)))[at].tolist()
        packed, at = links.tobytes(), (8 * at).tolist()
        found = ((packed[x:y], ";".join(groups[g:h]).encode()) for (x, y), (g, h) in zip(pairwise(at), pairwise(group)))
        return (next(found) if ok else None for ok in back.tolist())


@lru_cache(2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


# --- the walk ----------------------------------------------------------------
ONES = b"\1" * (1 << 16)


def aligned(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int, bool]]:
    """The stretches of two lists of rising ends with the same last one:
    ``i, i_end, j, j_end, single``, single for one-to-one groups, else one
    irregular group."""
    out = []
    i = j = 0
    n, m = len(ends_a), len(ends_b)
    while i < n:
        if ends_a[i] == ends_b[j]:
            k, step = 1, 4
            while ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step] and i + k < n:  # slices of one length: both end together
                k, step = k + step, 2 * step
            k, stop = min(k, n - i, m - j), min(n - i, m - j)
            while k < stop and ends_a[i + k] == ends_b[j + k]:
                step = max(1, step // 2)
                if ends_a[i + k : i + k + step] == ends_b[j + k : j + k + step]:
                    k = min(k + step, stop)
            out.append((i, i + k, j, j + k, True))
            i, j = i + k, j + k
            continue
        x, y = i, j
        a, b = ends_a[x], ends_b[y]
        while a != b:
            if a < b:
                x += 1
                a = ends_a[x]
            else:
                y += 1
                b = ends_b[y]
        out.append((i, x + 1, j, y + 1, False))
        i, j = x + 1, y + 1
    return out


def rises(ends_a: list[int], ends_b: list[int]) -> tuple[bytes, bytes]:
    """For an irregular group with these ends: link by link, by how much the
    place in A and in B rises. The first link rises in both."""
    both = sorted({*ends_a, *ends_b})[:-1]
    in_a, in_b = set(ends_a), set(ends_b)
    return b"\1" + bytes(e in in_a for e in both), b"\1" + bytes(e in in_b for e in both)


class Names(dict):
    """The text of a one-to-one group, by its link."""

    def __missing__(self, link: int) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        name = self[link] = f"{link >> 32}|{link & 0xFFFFFFFF}"
        return name


_names = Names()
#: By the packed ids of an irregular group: its rises, its text, its number of links.
_groups: dict[tuple[bytes, bytes], tuple[bytes, bytes, str, int]] = {}


def irregular(ids_a: bytes, ids_b: bytes, tokens_a: Tokens, tokens_b: Tokens) -> tuple[bytes, bytes, str, int]:
    a, b = np.frombuffer(ids_a, np.int32), np.frombuffer(ids_b, np.int32)
    rise_a, rise_b = rises(tokens_a.length[a].cumsum().tolist(), tokens_b.length[b].cumsum().tolist())
    text = f"{','.join([tokens_a.decimal[x] for x in a])}|{','.join([tokens_b.decimal[y] for y in b])}"
    if len(_groups) >= REMEMBERED:
        _groups.clear()
    group = _groups[ids_a, ids_b] = rise_a, rise_b, text, len(rise_a)
    return group


def linked(ids_a: np.ndarray, ids_b: np.ndarray, tokens_a: Tokens, tokens_b: Tokens) -> tuple[np.ndarray, list[str]]:
    """The links as ``a_id << 32 | b_id``, the first of each token marked with
    ``FIRST_A`` and ``FIRST_B`` (both where a group starts), and the groups' texts."""
    if not len(ids_a):
        return np.empty(0, np.int64), []
    packed_a, packed_b, known = ids_a.tobytes(), ids_b.tobytes(), _groups.get
    rise_a, rise_b, parts = [], [], []
    for i, i_end, j, j_end, single in aligned(tokens_a.length[ids_a].cumsum().tolist(), tokens_b.length[ids_b].cumsum().tolist()):
        if single:
            ones = ONES[: i_end - i] if i_end - i <= len(ONES) else b"\1" * (i_end - i)
            rise_a.append(ones)
            rise_b.append(ones)
            parts.append((None, i_end - i))
        else:
            key = packed_a[4 * i : 4 * i_end], packed_b[4 * j : 4 * j_end]
            group = known(key) or irregular(*key, tokens_a, tokens_b)
            rise_a.append(group[0])
            rise_b.append(group[1])
            parts.append(group[2:])
    first_a, first_b = (np.frombuffer(b"".join(r), np.uint8) for r in (rise_a, rise_b))
    at_a, at_b = (r.cumsum(dtype=np.int64) - 1 for r in (first_a, first_b))
    links = ids_a[at_a].astype(np.int64) << 32 | ids_b[at_b]
    every, groups, at = links.tolist(), [], 0
    for text, n in parts:
        if text is None:
            groups += map(_names.__getitem__, every[at : at + n])
        else:
            groups.append(text)
        at += n
    return links | np.where(first_a, FIRST_A, 0) | np.where(first_b, FIRST_B, 0), groups


# --- chunks ------------------------------------------------------------------
def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: its figures and ``places`` in its chunk's list of
    pairs, each so many ``times``; and a row per chunk with that list
    (``pairs``) and how many of its documents hold each (``held``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "pairs", "held"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lib, n, seq = pair(path_a, path_b), 0, TaskContext.get().partitionId() << 32
        rows, distinct, times = [], [], []

        def chunk() -> pd.DataFrame:
            every = np.concatenate([*distinct, np.empty(0, np.int64)])
            pairs, places, held = np.unique(every, return_inverse=True, return_counts=True)
            cuts = np.cumsum([len(d) for d in distinct])[:-1]
            out = [(seq, *r, p.astype(np.int32), t, None, None) for r, p, t in zip(rows, np.split(places, cuts), times)]
            out.append((seq, None, *[None] * 5, None, None, pairs, held.astype(np.int32)))
            return pd.DataFrame(out, columns=names).astype({"doc_id": "object", **dict.fromkeys(names[2:6], "Int64")})

        for b in batches:
            for doc_id, (links, groups) in zip(b["doc_id"], lib.read(b["text"])):
                first_a, first_b = links < 0, links & FIRST_B != 0
                codes, t = np.unique(links & ~(FIRST_A | FIRST_B), return_counts=True)
                figures = [int(np.count_nonzero(x)) for x in (first_a, first_b, first_a & first_b)]
                rows.append((doc_id, *figures, len(links), hashlib.sha256(groups).hexdigest() if groups else ""))
                distinct.append(codes)
                times.append(t.astype(np.int32))
                n += len(codes) + 1
                if n >= CHUNK:
                    yield chunk()
                    rows, distinct, times, n, seq = [], [], [], 0, seq + 1
        if rows:
            yield chunk()

    figures = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    lists = "places array<int>, times array<int>, pairs array<long>, held array<int>"
    return docs.select("doc_id", "text").mapInPandas(read, f"chunk long, doc_id {kind}, {figures}, {lists}")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row of ``docs``, with the byte-level vocabulary at
    ``path_a`` and the sentence pieces at ``path_b``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. A null or empty
    text, and one whose tokens don't give space and text back, has no tokens:
    zeros and an empty digest. Special strings inside texts are plain text.
    Repeated rows, and rows with equal or null ids, are documents of their own
    and count each. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    read = staged(chunks(docs, path_a, path_b), "align-chunks")
    lists = read.where("pairs is not null")
    counts = lists.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("count"))
    counts = staged(counts, "align-counts")
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))
    judged = counts.join(most, a_id == F.col("a_id")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    listed = lists.select("chunk", F.posexplode("pairs").alias("place", "code"))
    back = listed.join(judged, F.col("code") == F.col("pair")).select("chunk", "place", "count", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def add_up(docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        out = docs[names].astype({"doc_id": "object"})
        order = np.argsort(pairs["place"].to_numpy())
        count, best = pairs["count"].to_numpy(np.int64)[order], pairs["best"].to_numpy(np.int64)[order]
        sums = [(int(t @ best[p]), int(t @ count[p])) for p, t in zip(docs["places"], docs["times"].map(lambda t: np.asarray(t, np.int64)))]
        return out.assign(n_best=[s[0] for s in sums], count_sum=[s[1] for s in sums])

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    documents = read.where("pairs is null").select(F.col("chunk").alias("of"), *names, "places", "times")
    out = documents.groupBy("of").cogroup(back.groupBy("chunk")).applyInPandas(add_up, schema)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_align(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path
    return align(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
