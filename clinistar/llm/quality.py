"""Operator 8: quality rules, judged by isolation forests.

Rule statistics are counted over whole texts. Fixed base rules reject the
plainly broken; for the rest, an isolation forest per group of rules says how
few random splits set a document apart. How far apart is too far is read off
the labelled rows, for each forest on its own: a group in which good documents
are odd at times gets a threshold beyond them, or none.

The forests are fitted on a sample of at most ``SAMPLE`` documents, taken by a
hash of the id. Statistics, scores and thresholds cover all rows; thresholds
come from a histogram of the scores of all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import ASCII_BLANKS, staged, table, word_count

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Documents that the forests are fitted on, at most; trees, and rows of a tree.
SAMPLE, TREES, TREE_ROWS = 8192, 64, 256
SEED = 8
#: Rule statistics, per word or line, and the groups that each have a forest.
RATES = {
    "symbols": "n_symbols / n_words",
    "length": "word_chars / n_words",
    "lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
}
GROUPS = (("symbols",), ("symbols", "length"), ("lines", "repeats"))
#: Bins of a score; good documents lost weigh this much against bad ones caught.
BINS, COST = 2048, 200
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(text: str | None, window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more in the text.

    Words get numbers, and pairs of neighbouring numbers get numbers again,
    for 2, 4 and 8 words: equal numbers are equal windows, exactly.
    ``window`` is a power of two.
    """
    words = text.encode("utf-8", "replace").split() if text else ()  # bytes split at the ASCII blanks
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    step = 1
    while step < window:
        _, ids = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)
        step *= 2
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    return int((change.cumsum() > 0).sum())


def n_repeat_words(text: Column) -> Column:
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([repeated_words(t) for t in texts], dtype="int64")

    return count(text)


def rates() -> dict[str, Column]:
    """The rule statistics per word or line; 0 where there is none."""
    return {name: F.coalesce(F.expr(f"try_divide({r.replace(' / ', ', ')})"), F.lit(0.0)) for name, r in RATES.items()}


def counted(text: Column) -> dict[str, Column]:
    """The rule statistics that built-in functions count."""
    whole = F.coalesce(text, F.lit(""))
    without = lambda signs: F.translate(whole, signs, "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, ASCII_BLANKS, "") != "")
    return {
        "n_words": word_count(text),
        "word_chars": F.length(without(ASCII_BLANKS)).cast("long"),
        "n_symbols": (F.length(whole) - F.length(without(SYMBOLS))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def base_failed(n_words, n_repeat_words):
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the rule statistics of its ``text``, and ``base_failed``."""
    found = docs.drop(*STATS, "base_failed").withColumns(counted(F.col("text")) | {"n_repeat_words": n_repeat_words(F.col("text"))})
    return found.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))


def _usual_path(n: int) -> float:
    """Mean length of an unsuccessful search in a random tree of ``n`` rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A random tree: a row per node, ``feature (-1: leaf), cut, left, right, path``."""
    nodes: list[tuple] = []
    deepest = math.ceil(math.log2(max(2, len(rows))))

    def node(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = part.min(axis=0), part.max(axis=0)
        splits = np.flatnonzero(high > low)
        if depth == deepest or not len(splits):
            nodes[at] = (-1, 0.0, 0, 0, depth + _usual_path(len(part)))
        else:
            f = int(rng.choice(splits))
            cut = rng.uniform(low[f], high[f])
            left = part[:, f] <= cut
            nodes[at] = (f, cut, node(part[left], depth + 1), node(part[~left], depth + 1), 0.0)
        return at

    node(rows, 0)
    return np.array(nodes, dtype=np.float64)


def anomaly(trees: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """0 to 1, higher: set apart by fewer splits than usual."""
    if not trees:
        return np.zeros(len(rows))
    total, every = np.zeros(len(rows)), np.arange(len(rows))
    for t in trees:
        at = np.zeros(len(rows), dtype=np.int64)
        feature = t[:, 0].astype(np.int64)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes_left = rows[every, np.maximum(f, 0)] <= t[at, 1]
            at = np.where(inner, np.where(goes_left, t[at, 2], t[at, 3]), at).astype(np.int64)
        total += t[at, 4]
    return 2.0 ** (-(total / len(trees)) / max(_usual_path(TREE_ROWS), 1e-9))


@dataclass
class Model:
    forests: list[list[np.ndarray]]
    #: First bin of each forest's score that is rejected; BINS: none.
    thresholds: list[int]


def bins_of(forests: list[list[np.ndarray]], columns: list[pd.Series]) -> np.ndarray:
    """The bin of each forest's score, from the columns of ``RATES``."""
    names = list(RATES)
    x = np.column_stack([np.asarray(c, dtype=np.float64) for c in columns])
    scores = [anomaly(f, x[:, [names.index(r) for r in g]]) for f, g in zip(forests, GROUPS)]
    return np.minimum(np.column_stack(scores) * BINS, BINS - 1).astype(np.int32)


def score_bins(forests: list[list[np.ndarray]]) -> Column:
    """The bin of each forest's score, as an array column."""

    @F.pandas_udf("array<int>")
    def bins(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([*bins_of(forests, columns)])

    return bins(*rates().values())


def fit(statistics: DataFrame, labels: DataFrame) -> Model:
    """Forests from a bounded sample of ``statistics``, thresholds from all of
    ``labels`` (``doc_id, quality``; null labels are left out)."""
    candidates = statistics.where(~F.col("base_failed")).select(
        F.xxhash64(F.lit(SEED), "doc_id").alias("key"), *(r.alias(k) for k, r in rates().items())
    )
    sample = np.array([r[1:] for r in candidates.orderBy("key", *RATES).limit(SAMPLE).collect()], dtype=np.float64)
    names, rng = list(RATES), np.random.default_rng(SEED)
    forests = []
    for g in GROUPS:
        x = sample[:, [names.index(r) for r in g]] if len(sample) else sample
        pick = lambda x=x: x[rng.choice(len(x), min(TREE_ROWS, len(x)), replace=False)]
        forests.append([grow(pick(), rng) for _ in range(TREES)] if len(x) else [])
    known = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("label_id"), (F.col("quality") > 0).alias("good"))
    binned = statistics.where(~F.col("base_failed")).select("doc_id", F.posexplode(score_bins(forests)).alias("forest", "bin"))
    counts = binned.join(known, F.col("doc_id") == F.col("label_id")).groupBy("forest", "bin").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    histogram = np.zeros((len(GROUPS), 2, BINS))
    for forest, at, good, bad in counts.collect():  # at most a row for each forest and bin
        histogram[forest, :, at] = good, bad
    thresholds = []
    for good, bad in histogram:
        caught, lost = bad[::-1].cumsum()[::-1], good[::-1].cumsum()[::-1]
        gain = caught / max(1, bad.sum()) - COST * lost / max(1, good.sum())
        at = int(gain.argmax())
        if gain[at] <= 0 or not good.sum():
            thresholds.append(BINS)
            continue
        below = np.flatnonzero((good + bad)[:at])
        thresholds.append((at + int(below[-1]) + 1) // 2 if len(below) else at)  # halfway to the next score seen
    return Model(forests, thresholds)


def judged(statistics: DataFrame, model: Model) -> DataFrame:
    """``statistics`` with ``kept``."""
    bins = score_bins(model.forests)
    odd = F.exists(F.arrays_zip(bins.alias("bin"), F.array(*map(F.lit, model.thresholds)).alias("limit")), lambda x: x["bin"] >= x["limit"])
    return statistics.drop("kept").withColumn("kept", ~F.col("base_failed") & ~odd)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the rule statistics, ``base_failed`` and ``kept`` of every row.

    ``docs`` needs ``doc_id, text``, ``labels`` needs ``doc_id, quality``; other
    columns are ignored. A null or empty text has no words and fails; a null
    id is judged like any other and has no label; repeated rows are judged
    each. Without good labelled rows no forest rejects anything. No rows give
    no rows.
    """
    statistics = staged(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality-statistics")
    return judged(statistics, fit(statistics, labels)).drop("n_lines")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, whole. The texts are read twice and
    never shuffled: once for the model, once, in one pass, for the verdicts."""
    statistics = staged(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality-statistics")
    model = fit(statistics, labels)

    @F.pandas_udf("boolean")
    def kept(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for text, *columns in batches:
            seen = pd.DataFrame(dict(zip(names, columns)))
            seen["n_repeat_words"] = [repeated_words(t) for t in text]
            of = {k: v.split(" / ") for k, v in RATES.items()}
            rate = [(seen[a] / seen[b].where(seen[b] > 0)).fillna(0.0) for a, b in of.values()]
            odd = (bins_of(model.forests, rate) >= np.array(model.thresholds)).any(axis=1)
            yield ~base_failed(seen["n_words"], seen["n_repeat_words"]) & ~odd

    text = F.col("document.text")
    statistics_of = counted(text)
    names = list(statistics_of)
    inside = docs.select(F.struct(*docs.columns).alias("document"))
    return inside.where(kept(text, *statistics_of.values())).select("document.*")


def op8_quality(spark, sf_dir) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
