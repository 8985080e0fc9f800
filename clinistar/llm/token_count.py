"""Operator 2: token counts by the whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges each on its own. It is
proved once per vocabulary which vocabulary strings, standing alone, merge to
exactly one token (``Merges.whole``). A pre-token among them counts 1 without
merging; only the rest are merged. Results of merges are kept in a dictionary
of bounded size, so memory doesn't grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinistar.llm import merges
from clinistar.llm.common import table

#: How the byte-level vocabulary cuts texts (fixed pattern of that public vocabulary).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?<L>+| ?<N>+| ?<O>+|[<S>]+(?![^<S>])|[<S>]+"
LIMIT = 512
#: Merged pre-tokens that are remembered, and the longest of them in characters.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        self.merges = merges.load(path)
        self.whole = frozenset(self.merges.whole())
        self.cut = merges.Cutter(PRE_TOKEN)
        special = "|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True)))
        self.special = regex.compile(special) if special else None
        self.known: dict[str, int] = {}

    def _merged(self, pre_token: str) -> int:
        n = self.known.get(pre_token)
        if n is None:
            n = len(self.merges.merge(self.merges.symbols(pre_token)))
            if len(pre_token) <= REMEMBERED_CHARS:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[pre_token] = n
        return n

    def _plain(self, text: str) -> int:
        whole, known = self.whole, self.known
        total, rest = 0, 0
        for token in self.cut.words(text):
            if token in whole:
                total += 1
            else:
                rest += known.get(token) or self._merged(token)
        return total + rest

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(self._plain(p) for p in pieces)


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Tokens of ``text`` under the vocabulary at ``path``; a null text has 0."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            yield pd.Series([c.count(t) for t in texts], dtype="int64")

    return count(text)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. Only the text
    goes to Python, nothing is shuffled. A null or empty text has 0 bytes and
    tokens; a null id stays null; repeated rows are counted each. A special
    string inside a text is one token, as the library has it by default.
    """
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n_tokens(F.col("text"), path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
