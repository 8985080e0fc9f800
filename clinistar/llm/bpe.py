"""Operator 3: BPE encoding and decoding by a bounded-lookahead transducer.

The merge list's sufficient lookahead L is computed once (``Merges.lookahead``):
tokens that end L or more symbols before the end of what has been read can't
change any more. The encoder therefore reads a word in blocks, merges what it
holds, emits the tokens that are stable and keeps the rest: its memory is one
block and L, however long a word is. Ordinary words fit one block and are
remembered in a dictionary of bounded size.

The decoder is a state machine over token ids. Its state is whether a token
was given out before (``feed``, what the library's decode gives) or the bytes
of an unfinished character (``text``, on to the words). Both digests are fed
piece by piece: one with the ids, the other with what the decoder makes of them.
"""

from __future__ import annotations

import codecs
import hashlib
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import pandas as pd
import regex
from pyspark.sql import DataFrame

from clinistar.llm import merges
from clinistar.llm.common import table

#: How the word-end vocabulary cuts normalised texts (fixed pattern of that public vocabulary).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|<L>+|<N>|<O>+"
#: Symbols that the transducer reads at once, besides its lookahead.
BLOCK = 4096
#: Pre-tokens handed to the digests at once.
GROUP = 8192
#: Words that are remembered, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 150_000, 64


def lower(text: str) -> str:
    """Lower case letter by letter: no letter depends on its neighbours."""
    return text.replace("Σ", "σ").lower()


class Encoder:
    """Encodes texts for one vocabulary file."""

    def __init__(self, path: str, block: int = BLOCK):
        self.merges = merges.load(path)
        self.block, self.lookahead = block, self.merges.lookahead()
        self.cut = merges.Cutter(PRE_TOKEN)
        special = "|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True)))
        self.special = regex.compile(f"({special})") if special else None
        self.known: dict[str, bytes] = {}

    def tokens(self, word: str) -> Iterator[str]:
        """The tokens of one pre-token, each as soon as it is stable."""
        m, held, at = self.merges, [], 0
        while True:
            piece = word[at : at + self.block]
            at += len(piece)
            held += m.symbols(piece, ends=at >= len(word))
            merged = m.merge([*held])
            if at >= len(word):
                yield from merged
                return
            stable, length = len(held) - self.lookahead, 0
            for t in merged:
                if length + m.length(t) > stable:
                    break
                length += m.length(t)
                yield t
            held = held[length:]

    def pieces(self, text: str) -> Iterator[bytes]:
        """For each pre-token or special string in order: its ids packed."""
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                yield merges.pack([self.merges.special[part]])
                continue
            part = lower(unicodedata.normalize("NFC", part))
            for word in self.cut.words(part):
                if (got := self.known.get(word)) is not None:
                    yield got
                elif len(word) <= REMEMBERED_CHARS:
                    got = self._pack([*self.tokens(word)])
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[word] = got
                    yield got
                else:
                    some = []
                    for t in self.tokens(word):
                        some.append(t)
                        if len(some) == GROUP:
                            yield self._pack(some)
                            some = []
                    if some:
                        yield self._pack(some)

    def _pack(self, tokens: list[str]) -> bytes:
        return merges.pack([self.merges.ids[t] for t in tokens])

    def ids(self, text: str) -> list[int]:
        return [i for ids in self.pieces(text) for i in unpacked(ids)]


def unpacked(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


class Decoder:
    """From ids to text, piece by piece.

    ``joined`` gives what the library's decode gives for a vocabulary file
    without a decoder: the tokens' strings with a space between. ``text`` goes
    on to the words: letters back to bytes, a word end as a space, bytes to
    characters as soon as one is complete.
    """

    def __init__(self, path: str):
        m = merges.load(path)
        self.suffix = m.suffix
        self.string = {i: t for t, i in m.ids.items()} | {i: t for t, i in m.special.items()}
        value = {c: b for b, c in enumerate(merges.byte_letters())}
        self.bytes = {}
        for t, i in m.ids.items():
            ends = bool(m.suffix) and t.endswith(m.suffix)
            body = t[: len(t) - len(m.suffix)] if ends else t
            self.bytes[i] = bytes(value[c] for c in body if c in value) + b" " * ends
        self.bytes |= {i: t.encode() + b" " for t, i in m.special.items()}

    def feed(self, ids: Iterable[int], begun: bool) -> tuple[str, bool]:
        """What ``joined`` gives for the next ids, and the state after them."""
        strings = [t for t in map(self.string.get, ids) if t is not None]
        return " " * (begun and bool(strings)) + " ".join(strings), begun or bool(strings)

    def joined(self, ids: Iterator[int]) -> Iterator[str]:
        begun = False
        for i in ids:
            out, begun = self.feed((i,), begun)
            yield out

    def text(self, ids: Iterator[int]) -> Iterator[str]:
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if out := state.decode(self.bytes.get(i, b"")):
                yield out
        if out := state.decode(b"", True):
            yield out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode_digests(text: str | None, path: str) -> tuple[int, str, str]:
    """Tokens, digest of the ids, digest of the text decoded from these ids."""
    n, ids_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()
    pieces, decode, begun = encoder(path).pieces(text or ""), decoder(path).feed, False
    while group := [*islice(pieces, GROUP)]:
        ids = b"".join(group)
        ids_digest.update(ids)
        out, begun = decode(unpacked(ids), begun)
        text_digest.update(out.encode())
        n += len(ids) // 4
    return n, ids_digest.hexdigest(), text_digest.hexdigest()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. Nothing is
    shuffled. A null or empty text has no tokens and the digests of nothing; a
    null id stays null; repeated rows are encoded each.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, ids, text = zip(*[encode_digests(t, path) for t in b["text"]]) if len(b) else ((), (), ())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": pd.Series(n, index=b.index, dtype="int64"), "ids_sha256": pd.Series(ids, index=b.index, dtype=object), "decoded_sha256": pd.Series(text, index=b.index, dtype=object)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(encode, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
