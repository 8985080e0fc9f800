"""Operator 11: SimHash near duplicates by the generalised pigeonhole principle.

A text's fingerprint has 64 bits: a bit is 1 if it is set in over half the
hashes of the text's shingles. Texts link if their fingerprints differ in at
most ``TAU`` bits.

Cut the bits into m parts and give part i a threshold t_i >= -1. If the t_i of
a fingerprint x sum to TAU - m + 1, every y within TAU of x is within t_i of x
in at least one part i: else they would differ in at least
``sum(t_i + 1) = TAU + 1`` bits. A part with -1 isn't looked at.

1. Bits are grouped by their correlation over all distinct fingerprints:
   correlated bits share a part, so the parts are nearly independent.
2. Each fingerprint gets its own thresholds: a dynamic program over the parts
   takes the cheapest, where a threshold costs the values to be probed and the
   estimated candidates behind them. The estimate comes from counts of all
   values of 16-bit blocks; blocks of a part count as independent.
3. Every distinct fingerprint is indexed by its value in each part, and probes
   all values within its thresholds. Candidates are verified on all 64 bits.
4. A bucket of more than ``LARGEST`` fingerprints isn't compared: the same
   principle divides it by the bits that its part leaves open, until at most 8
   bits are open and a bucket can hold no more than 256. So no bucket yields
   the pairs of a large group, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations, product, repeat
from operator import or_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinistar.llm.common import discard, staged, table
from clinistar.llm.components import components

WORDS, SEED = 3, 42
#: Bits in which linked fingerprints differ at most.
TAU = 3
#: Bits of each part. Two halves keep buckets small up to some billions of
#: fingerprints; beyond, buckets are divided.
WIDTHS = (32, 32)
#: Bits of a block whose values are counted.
BLOCK = 16
#: Fingerprints of a bucket that are compared without dividing it.
LARGEST = 32
#: What a candidate costs, in probed values.
CANDIDATE = 0.05
#: Shingles hashed at once.
AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - WORDS + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, AT_ONCE):
        part = words[start : start + AT_ONCE + WORDS - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(WORDS)))) if len(words) >= WORDS else [b" ".join(words)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column) -> Column:
    """The fingerprint of ``text`` as a long with the same bits."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return of(text)


def bits_of(fp: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each fingerprint, lowest bit first."""
    return np.unpackbits(np.ascontiguousarray(fp, dtype=np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(bits) -> int:
    return reduce(or_, (1 << int(b) for b in bits), 0)


# --- 1: parts --------------------------------------------------------------
def correlations(nodes: DataFrame) -> np.ndarray:
    """Absolute correlations of the 64 bits over all rows of ``nodes``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            x = bits_of(b["fp"].to_numpy()).astype(np.float64)
            both, n = both + x.T @ x, n + len(x)
        if n:
            i, j = np.divmod(np.arange(64 * 64), 64)
            yield pd.DataFrame({"i": np.r_[i, -1], "j": np.r_[j, -1], "n": np.r_[both.ravel().astype(np.int64), n]})

    rows = nodes.select("fp").mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect()  # 4,097 rows
    got = {(i, j): n for i, j, n in rows}
    n = got.get((-1, -1), 0)
    if not n:
        return np.zeros((64, 64))
    both = np.array([[got[i, j] for j in range(64)] for i in range(64)]) / n
    p = both.diagonal()
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return np.divide(np.abs(both - np.outer(p, p)), spread, out=np.zeros((64, 64)), where=spread > 0)


def grouped(bits: list[int], widths, corr: np.ndarray) -> list[list[int]]:
    """``bits`` dealt to groups of these widths: each starts with the most
    correlated pair left and takes the bit closest to what it has."""
    left, out = list(bits), []
    for width in widths:
        group: list[int] = []
        if width >= len(left):
            group, left = left, []
        elif width > 1:
            group = list(max(combinations(left, 2), key=lambda ab: (corr[ab], -ab[0], -ab[1])))
        while len(group) < width and left:
            left = [b for b in left if b not in group]
            group.append(max(left, key=lambda b: (corr[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        out.append(group)
    return out


# --- 2: thresholds -----------------------------------------------------------
def gathered(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The value of ``fp`` in these bits, the first as the lowest."""
    fp = np.ascontiguousarray(fp, dtype=np.int64).view(np.uint64)
    out = np.zeros(len(fp), np.int64)
    for k, b in enumerate(bits):
        out |= (((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)).astype(np.int64)
    return out


def value_counts(nodes: DataFrame, blocks: list[list[int]]) -> list[np.ndarray]:
    """How many rows have each value of each block: at most 2**BLOCK numbers a block."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.zeros(1 << len(block), np.int64) for block in blocks]
        for b in batches:
            fp = b["fp"].to_numpy()
            for h, block in zip(held, blocks):
                h += np.bincount(gathered(fp, block), minlength=len(h))
        for k, h in enumerate(held):
            value = np.flatnonzero(h)
            yield pd.DataFrame({"block": k, "value": value, "n": h[value]})

    rows = nodes.select("fp").mapInPandas(count, "block int, value int, n long").groupBy("block", "value").agg(F.sum("n").alias("n")).toPandas()
    out = []
    for k, block in enumerate(blocks):
        own = rows[rows["block"] == k]
        h = np.zeros(1 << len(block), np.float64)
        h[own["value"].to_numpy()] = own["n"].to_numpy()
        out.append(h)
    return out


def shells(h: np.ndarray) -> np.ndarray:
    """Column d: how many rows differ from each value in exactly d bits, for d up to TAU."""
    width, at = len(h).bit_length() - 1, np.arange(len(h))
    return np.stack([sum((h[at ^ mask_of(flip)] for flip in combinations(range(width), d)), np.zeros(len(h))) for d in range(TAU + 1)], axis=1)


@cache
def ball(width: int, radius: int) -> int:
    """Values of ``width`` bits within ``radius`` of one."""
    return sum(1 for d in range(radius + 1) for _ in combinations(range(width), d))


def candidates(fp: np.ndarray, blocks: list[list[int]], near: list[np.ndarray], n: int) -> np.ndarray:
    """Column t: the estimated rows within t of each fingerprint in a part of these blocks."""
    exact = np.zeros((len(fp), TAU + 1))
    exact[:, 0] = n
    for block, shell in zip(blocks, near):
        share = shell[gathered(fp, block)] / max(1, n)
        exact = np.stack([sum(exact[:, k] * share[:, d - k] for k in range(d + 1)) for d in range(TAU + 1)], axis=1)
    return exact.cumsum(axis=1)


def allocate(costs: list[np.ndarray]) -> np.ndarray:
    """The cheapest thresholds. ``costs[i][:, t]`` is what threshold t of part
    i costs, -1 costs nothing. Returns t_i + 1 per part as digits of base
    TAU + 2, the first part lowest."""
    rows, total = len(costs[0]), TAU + 1
    best = np.full((rows, total + 1), np.inf)
    best[:, 0] = 0
    code = np.zeros((rows, total + 1), np.int64)
    for i, cost in enumerate(costs):
        step = np.hstack([np.zeros((rows, 1)), cost])  # by t + 1
        options = np.stack([np.stack([best[:, s - u] + step[:, u] if u <= s else np.full(rows, np.inf) for u in range(total + 1)], axis=1) for s in range(total + 1)], axis=1)
        took = options.argmin(axis=2)
        back = np.arange(total + 1)[None, :] - took
        code = np.take_along_axis(code, back, axis=1) + took * (TAU + 2) ** i
        best = np.take_along_axis(options, took[:, :, None], axis=2)[:, :, 0]
    return code[:, total]


def thresholds(fp: Column, parts: list[list[list[int]]], near, n: int) -> Column:
    """The code of each fingerprint's own thresholds. ``parts``: each a list of
    blocks; ``near``: a broadcast of their ``shells``."""

    @F.pandas_udf("int")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            x, k, costs = b.to_numpy(), 0, []
            for blocks in parts:
                found = candidates(x, blocks, near.value[k : k + len(blocks)], n)
                values = [ball(sum(map(len, blocks)), t) for t in range(TAU + 1)]
                costs.append(np.array(values) + CANDIDATE * found)
                k += len(blocks)
            yield pd.Series(allocate(costs).astype(np.int32))

    return code(fp)


# --- 3, 4: probe, divide, verify ---------------------------------------------
def flips(bits: list[int], radius: int) -> list[int]:
    """Masks of at most ``radius`` of these bits; none if it is negative."""
    return [mask_of(c) for d in range(radius + 1) for c in combinations(bits, d)]


def divided(left: int) -> tuple[int, int]:
    """Thresholds of two parts that find all within ``left`` bits."""
    return left // 2, (left + 1) // 2 - 1


class Level:
    """Which buckets a level makes of those of the level before.

    A bucket is known by its ``node``, which says what bits are fixed, and the
    ``value`` of those. ``nodes`` maps a node to its open bits. Both tables
    have a fixed size.
    """

    def __init__(self, spark: SparkSession, index: list, probe: list, nodes: dict):
        kind = "node int, {}child int, bits long"
        self.index = F.broadcast(spark.createDataFrame(pd.DataFrame(index, columns=["node", "child", "bits"]), kind.format("")))
        self.probe = F.broadcast(spark.createDataFrame(pd.DataFrame(probe, columns=["node", "left", "child", "bits", "fixed", "flip"]), kind.format("left int, ") + ", fixed long, flip long"))
        self.nodes = nodes


def levels(spark: SparkSession, parts: list[list[int]]) -> Iterator[Level]:
    """First the parts, with a row for each code of thresholds; then halves of what is open."""
    index, probe, nodes = [], [], {}
    every = sorted(b for p in parts for b in p)
    for i, bits in enumerate(parts):
        mask = signed(mask_of(bits))
        index.append((0, i, mask))
        nodes[i] = [b for p in parts for b in p if b not in bits]
    for digits in product(range(TAU + 2), repeat=len(parts)):
        if sum(digits) == TAU + 1:
            code = sum(u * (TAU + 2) ** i for i, u in enumerate(digits))
            for i, (bits, u) in enumerate(zip(parts, digits)):
                mask = signed(mask_of(bits))
                probe += [(0, code, i, mask, mask, signed(f)) for f in flips(bits, u - 1)]
    yield Level(spark, index, probe, nodes)
    while max(map(len, nodes.values())) > 8:
        index, probe, below = [], [], {}
        for node, open_ in nodes.items():
            half = (len(open_) + 1) // 2
            fixed = mask_of(b for b in every if b not in open_)
            for k, bits in enumerate((open_[:half], open_[half:])):
                child, now = len(below), signed(fixed | mask_of(bits))
                below[child] = [b for b in open_ if b not in bits]
                index.append((node, child, signed(mask_of(bits))))
                for left in range(TAU + 1):
                    probe += [(node, left, child, signed(mask_of(bits)), now, signed(f)) for f in flips(bits, divided(left)[k])]
        nodes = below
        yield Level(spark, index, probe, nodes)


def links(nodes: DataFrame) -> DataFrame:
    """All pairs ``a, b`` of the distinct fingerprints ``fp`` that differ in at
    most TAU bits; a pair may come more than once. ``nodes`` is read often."""
    spark, n = nodes.sparkSession, nodes.count()
    corr = correlations(nodes)
    parts = grouped(list(range(64)), WIDTHS, corr)
    blocks = [grouped(p, [BLOCK] * -(-len(p) // BLOCK), corr) for p in parts]
    near = spark.sparkContext.broadcast([shells(h).astype(np.float32) for h in value_counts(nodes, [b for p in blocks for b in p])])  # 1 MB a block
    index = nodes.select(F.lit(0).cast("long").alias("value"), "fp")
    probe = index.withColumn("left", thresholds(F.col("fp"), blocks, near, n))
    found = []
    for depth, level in enumerate(levels(spark, parts)):
        below = F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.col("bits")))
        if depth:
            index = index.join(level.index, "node").select(F.col("child").alias("node"), below.alias("value"), "fp")
        else:
            masks = F.array(*(F.lit(signed(mask_of(bits))) for bits in parts))
            index = index.select("value", "fp", F.posexplode(masks).alias("node", "bits")).select("node", below.alias("value"), "fp")
        below = F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.col("bits")).bitwiseXOR(F.col("flip")))
        probe = probe.join(level.probe, ["node", "left"] if depth else "left").select(F.col("child").alias("node"), below.alias("value"), "fp", "fixed")
        left = F.lit(TAU) - F.bit_count(F.col("fp").bitwiseXOR(F.col("value")).bitwiseAND(F.col("fixed")))
        probe = probe.select("node", "value", "fp", left.cast("int").alias("left"))
        last = max(map(len, level.nodes.values())) <= 8
        large = None
        if not last:
            large = staged(index.groupBy("node", "value").count().where(F.col("count") > LARGEST).select("node", "value"), "simhash-large")
            if large.isEmpty():
                large = None
        here = (index, probe) if large is None else tuple(t.join(large, ["node", "value"], "left_anti") for t in (index, probe))
        met = here[1].join(here[0].withColumnRenamed("fp", "other").hint("shuffle_hash"), ["node", "value"])
        met = met.where((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= TAU))
        found.append(staged(met.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct(), "simhash-links"))
        if large is None:
            break
        index, probe = (staged(t.join(large, ["node", "value"], "left_semi"), "simhash-divided") for t in (index, probe))
    return reduce(DataFrame.unionByName, found)


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text``; other columns are ignored. A null or
    empty text, or one of blanks, has fingerprint zero and is linked like any
    other; fewer than three words are one shingle. Texts of any length are
    hashed in pieces. Rows with equal fingerprints are one node, so repeated
    rows and large groups of copies cost one node. Null ids don't count
    towards the smallest id; a component of such rows alone has a null id. No
    rows give no rows.
    """
    rows = staged(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash-rows")
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = links(nodes.select("fp"))
    roots = staged(components(found), "simhash-roots")
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(ids, "root").select(F.col("fp").alias("of"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    out = rows.join(labels, F.col("fp") == F.col("of")).select("doc_id", hexed, "component_id")
    discard(docs.sparkSession)
    return out


def op11_simhash(spark, sf_dir) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
