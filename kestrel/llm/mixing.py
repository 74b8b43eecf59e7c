"""Mixing sources to target weights, by Efraimidis-Spirakis sampling and DataFrame functions alone.

Every document gets the key -ln(u) / quality, where u comes from a digest of the seed and its doc_id, so
reruns agree.  Within a source, documents in key order are a weighted sample without replacement.
A source's target is first met by complete epochs over all its documents; the rest of the budget goes
to the documents in key order whose running sum reaches it (the last one if that comes nearer).

No source is ever sorted whole.  Keys fall into 2**20 ordered bins; sums of 1024 coarse bins per source
(pre-aggregated) locate the coarse bin where the budget ends, sums of its 1024 fine bins the fine bin, and
only documents of that bin, about a millionth of the source, are sorted and prefix-summed.

Targets share the sum of all sizes by weight (1, 2, 3 in turn over the sources by code point, null last),
but stop at ``max_epochs`` times the source's size; the excess is reshared by weight.  With the sources in
order of size per weight, those that stop form a prefix, so running sums give the common level at once.

Quality is 0.5 + distinct words / words of the text (0.5 without words).

Defined results: a null or blank text has size 0 and takes 0 words.  A null source is a source.  A null doc_id
has a key like any other.  Rows that repeat a doc_id share a key and are taken one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kestrel.llm.common import store, table, word_array

FINE = 1024


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """(row, source, size, rank_key, bin) of every document."""
    words = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"),
                        F.size(word_array(F.col("text"))).cast("long").alias("size"),
                        F.size(F.array_distinct(word_array(F.col("text")))).alias("kinds"))
    quality = F.lit(0.5) + F.when(F.col("size") > 0, F.col("kinds") / F.col("size")).otherwise(F.lit(0.0))
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    keyed = words.select("row", "source", "size", (-F.log(u) / quality).alias("rank_key"))
    return keyed.withColumn("bin", F.least(F.lit(FINE * FINE - 1), F.floor((1 - F.exp(-F.col("rank_key"))) * (FINE * FINE)).cast("int")))


def targets(docs: DataFrame, max_epochs: int) -> DataFrame:
    """(source, source_size, target, epochs, budget), one row a source."""
    s = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row a source: these windows see no documents
    s = s.withColumn("weight", F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(3)) + 1)
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward))
    free = F.col("level") * F.col("weight") <= F.col("cap")
    common = F.max(F.when(free, F.col("level"))).over(everything)
    s = s.withColumn("target", F.when(free, common * F.col("weight")).otherwise(F.col("cap")).cast("double"))
    size = F.col("source_size")
    s = s.withColumn("epochs", F.when(size > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / size))).otherwise(0).cast("int"))
    return s.select("source", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * size).alias("budget"))


def _crossing(sums: DataFrame, plan: DataFrame, spent: Column, out: str) -> DataFrame:
    """Per source the first bin whose running sum passes the budget, and the sum before it (beyond all bins if none does)."""
    run = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("total").over(run)).withColumnsRenamed({"source": "source2"})
    hit = plan.join(sums, F.col("source").eqNullSafe(F.col("source2")) & (spent + F.col("upto") > F.col("budget")))
    first = hit.groupBy("source").agg(F.min(F.struct(F.col("part"), (F.col("upto") - F.col("total")).alias("before"))).alias("hit")).withColumnsRenamed({"source": "source3"})
    return (plan.join(first, F.col("source").eqNullSafe(F.col("source3")), "left")
            .select(*plan.columns, F.coalesce("hit.part", F.lit(FINE)).alias(out), F.coalesce("hit.before", F.lit(0)).alias(out + "_before")))


def mix_plan(docs: DataFrame, max_epochs: int) -> DataFrame:
    """targets() with ``edge``, the fine bin where the budget ends, and ``spent``, the words of the bins before it."""
    plan = store(targets(docs, max_epochs), "targets")
    coarse = docs.groupBy("source", F.floor(F.col("bin") / FINE).cast("int").alias("part")).agg(F.sum("size").alias("total"))
    plan = store(_crossing(coarse, plan, F.lit(0), "c"), "targets")
    near = docs.withColumnsRenamed({"source": "source4"}).join(
        plan.select("source", "c"), F.col("source4").eqNullSafe(F.col("source")) & (F.floor(F.col("bin") / FINE) == F.col("c")))
    fine = near.groupBy("source", (F.col("bin") % FINE).alias("part")).agg(F.sum("size").alias("total"))
    plan = store(_crossing(fine, plan, F.col("c_before"), "f"), "targets")
    return plan.select("source", "source_size", "target", "epochs", "budget", (F.col("c") * FINE + F.col("f")).alias("edge"),
                       (F.col("c_before") + F.col("f_before")).alias("spent"))


def mixed(docs: DataFrame, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """(row, size, source_size, target, copies): how often the mix takes each document; ``row`` holds the columns of ``docs``."""
    rows = sized(docs, seed)
    return _take(rows, mix_plan(store(rows.select("source", "size", "bin"), "sizes"), max_epochs))


def _take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    both = rows.withColumnsRenamed({"source": "source5"}).join(plan, F.col("source5").eqNullSafe(F.col("source")))
    out = ["row", "size", "source_size", "target"]
    # whole epochs without a rest are all, also for documents of no words; a source of no words at all is taken once
    more = (F.col("budget") > 0) | (F.col("epochs") == 0)
    clear = both.where("bin <> edge").select(*out, (F.col("epochs") + (more & (F.col("bin") < F.col("edge"))).cast("int")).alias("copies"))
    run = Window.partitionBy("source").orderBy("rank_key", "row.doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("spent") + F.coalesce(F.sum("size").over(run), F.lit(0))
    edge = (both.where("bin = edge").withColumn("before", before)
            .select(*out, (F.col("epochs") + (more & (F.col("before") + F.col("size") / 2 <= F.col("budget"))).cast("int")).alias("copies")))
    return clear.unionByName(edge)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with the columns of ``docs``."""
    taken = mixed(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select(*(F.col("row")[c].alias(c) for c in docs.columns))


# ---------------------------------------------------------------- registered query

def op6_mix_sources(spark, sf_dir):
    rows = sized(table(spark, sf_dir, "documents"), "mix")
    rows = store(rows.select(F.struct("row.doc_id").alias("row"), "source", "size", "rank_key", "bin"), "sizes")
    return _take(rows, mix_plan(rows, 3)).select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = r"""
WITH w AS (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
d AS (
  SELECT doc_id, source, len(words) AS size,
         -ln((('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
           / (0.5 + CASE WHEN len(words) > 0 THEN len(list_distinct(words)) / len(words) ELSE 0.0 END) AS rank_key
  FROM w),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
l AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size,
         (CASE WHEN level * weight <= cap THEN weight * max(CASE WHEN level * weight <= cap THEN level END) OVER () ELSE cap END)::DOUBLE AS target
  FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END AS epochs FROM t),
c AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.rank_key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN before + size / 2 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
