"""Operator 1: mixing sources to target weights.

Every document gets a hash-random key, the documents of a source are ordered
by it, distributed prefix sums of their sizes run along that order, and each
source is cut exactly where its budget ends. A budget above the source's own
size repeats the whole source first (epochs) and cuts the last pass.

A source may hold a third of all rows, so no window runs over a whole source.
Keys are uniform, hence equal ranges of the key space are balanced range
partitions: a source of n rows is split into about n / ``RANGE_ROWS`` ranges.
One window sums inside each range, a second one over one row per range gives
the sum of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinistar.llm.common import staged, table, word_count

#: Weights dealt to the sources in order, repeating (query parameter).
WEIGHTS = (5, 2, 1)
#: A source is used at most this many times over.
MAX_EPOCHS = 3
#: Rows of one range of keys, about.
RANGE_ROWS = 4096
SEED = "mix-1"
KEY_BITS = 60


def random_key(doc_id: Column, size: Column, seed: str = SEED) -> Column:
    """A 60-bit hash-random key; the same row gets the same key in every run."""
    text = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, target, epochs, rest, bits, sid``.

    ``sizes`` has ``source, size``. Sources in code point order, null last,
    take the weights in turn and share the sum of all sizes; a target stops at
    ``max_epochs`` times the source's size and what it can't use is shared by
    the others, again by weight. That fixed point is reached in one pass: by
    rising cap per weight, a source is capped if its share of what the sources
    before it leave is at least its cap. The window has one row per source of
    the recipe, which is all that meets in one task.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    in_order = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return (
        per.withColumn("sid", F.row_number().over(in_order))
        .withColumn("w", w.cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(by_cap), zero))
        .withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(by_cap), zero))
        .withColumn("capped", F.col("left") * F.col("w") >= F.col("cap") * F.col("left_w"))
        .withColumn("free", F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), zero))
        .withColumn("free_w", F.coalesce(F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything), zero))
        .withColumn(
            "target",
            F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
                (F.col("w") * F.col("free")).cast("double") / F.col("free_w").cast("double")
            ),
        )
        .withColumn("budget", F.floor(F.col("target") + 0.5))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(zero))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("bits", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / RANGE_ROWS))).cast("int"))
        .select("sid", "source", "source_size", "target", "epochs", "rest", "bits")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, key, source_size, target, taken`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text, source``; other columns are ignored.
    ``taken`` is how many of the document's words the mix takes, repeats
    counted: ``epochs`` times its size, and in the last pass its whole size,
    nothing, or, for the document at the cut, the words up to the budget. The
    sum over a source is its target rounded to a whole word.

    A null or empty text has size 0 and takes nothing; a null source is a
    source of its own; a null id is a key like any other. Repeated rows are
    separate documents, alike in everything but which of them the cut meets.
    No rows give no rows.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sized = staged(sized.withColumn("key", random_key(F.col("doc_id"), F.col("size"), seed)), "mix-sizes")
    recipe = staged(targets(sized, weights, max_epochs), "mix-targets")
    ranged = (
        sized.withColumnRenamed("source", "from")
        .join(recipe, F.col("from").eqNullSafe(F.col("source")))
        .withColumn("range", F.expr(f"shiftright(key, {KEY_BITS} - bits)"))
    )
    sums = ranged.groupBy("sid", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sid", "range").orderBy("key", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset") - (F.col("running") - F.col("size"))))
    return (
        ranged.withColumn("running", running)
        .join(sums, ["sid", "range"])
        .withColumn("taken", (F.col("epochs") * F.col("size") + last).cast("long"))
        .select("doc_id", "source", "size", "key", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as the mix repeats them, whole texts only.

    A document appears once for each full pass, and once more if the cut pass
    takes any of its words: the document at the cut stays whole. Documents the
    mix doesn't reach go.

    The text isn't joined back by id. A source's cut is one key, so each row
    is compared with its source's cut: one small row per source. All columns
    of ``docs`` stay as they are, whatever their names. Null, empty and blank
    texts have no words and go; a null source is one of its own; repeated rows
    are separate documents. No rows give no rows.
    """
    plan = mix(docs, **options)
    place = F.struct("key", "doc_id", "size")
    cuts = staged(
        plan.groupBy("source").agg(
            F.max(F.when(F.col("size") > 0, F.expr("taken div size"))).alias("most"),
            F.min(F.when(F.col("size") > 0, F.expr("taken div size"))).alias("passes"),
            F.max(F.when(F.expr("taken % greatest(size, 1) > 0"), place)).alias("part"),
            F.max(F.struct(F.expr("taken div greatest(size, 1)").alias("times"), "key", "doc_id", "size")).alias("top"),
        ).withColumn(
            "cut",
            F.coalesce("part", F.when(F.col("most") > F.col("passes"), F.struct("top.key", "top.doc_id", "top.size"))),
        ).select(F.col("source").alias("mix_source"), "passes", "cut"),
        "mix-cuts",
    )
    size = word_count(F.col("row.text"))
    here = F.struct(random_key(F.col("row.doc_id"), size, options.get("seed", SEED)).alias("key"), F.col("row.doc_id"), size.alias("size"))
    times = F.col("passes") + F.when(F.col("cut").isNotNull() & (here <= F.col("cut")), 1).otherwise(0)
    return (
        docs.select(F.struct("*").alias("row"))
        .join(cuts, F.col("row.source").eqNullSafe(F.col("mix_source")))
        .where(size > 0)
        .withColumn("mix_pass", F.explode(F.sequence(F.lit(0), times.cast("int"))))
        .where(F.col("mix_pass") > 0)
        .select("row.*")
    )


def op1_mix(spark, sf_dir) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, size,
         ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || size), 1, 15))::BIGINT AS key
  FROM (SELECT doc_id, source,
               coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents)),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid
        FROM sized GROUP BY source),
weighted AS (SELECT *, (CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w,
                    3 * source_size AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM per),
shared AS (SELECT *,
    (total - coalesce(sum(cap) OVER earlier, 0))::BIGINT AS remaining,
    (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0))::BIGINT AS remaining_w
  FROM weighted WINDOW earlier AS (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, remaining * w >= cap * remaining_w AS full_cap FROM shared),
goals AS (SELECT *, CASE WHEN full_cap THEN cap::DOUBLE ELSE
    (w * (total - coalesce(sum(cap) FILTER (full_cap) OVER (), 0))::BIGINT)::DOUBLE
      / (sum(w) FILTER (NOT full_cap) OVER ())::DOUBLE END AS target FROM capped),
budgets AS (SELECT *, floor(target + 0.5)::BIGINT AS budget FROM goals),
sums AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS before FROM sized)
SELECT s.doc_id, s.size, b.source_size, b.target,
       (CASE WHEN b.source_size = 0 THEN 0 ELSE (b.budget // b.source_size) * s.size
         + greatest(0, least(s.size, b.budget % b.source_size - s.before)) END)::BIGINT AS taken
FROM sums s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
"""
