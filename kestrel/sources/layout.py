"""Z-order clustering: rows sorted by interleaved bits of several columns, so that statistics of files and row
groups exclude most of a table for a range of any one of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def z_value(columns: list[Column], bits: int = 16) -> Column:
    """Interleaved lowest ``bits`` bits of non-negative integer columns (bits times columns at most 62)."""
    n = len(columns)
    parts = [F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), b * n + i)
             for b in range(bits) for i, c in enumerate(columns)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _upto(bounds: Column, value: Column, steps: Column) -> Column:
    """How many of the sorted ``bounds`` are not above ``value``; ``steps`` are falling powers of two."""
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(bounds, at + step - 1) <= value, step).otherwise(0))


def z_ordered(df: DataFrame, columns: list[str], files: int, bits: int = 10) -> DataFrame:
    """``df`` range-partitioned and sorted by the Z-value of ``columns`` (numbers or times).

    Each column is cut at its approximate quantiles (2**bits of them, computed in Spark; a bounded list a column), so skew within
    a column does not waste bits.  Nulls come first.  A column of one value adds nothing.
    """
    cuts = 1 << bits
    as_double = {c: F.col(c).cast("timestamp").cast("double") if dict(df.dtypes)[c].startswith(("timestamp", "date")) else F.col(c).cast("double") for c in columns}
    at = F.array(*(F.lit(i / cuts) for i in range(1, cuts)))
    row = df.agg(*(F.percentile_approx(as_double[c], at, 10 * cuts).alias(c) for c in columns)).first()
    ranks = []
    for c in columns:
        bounds = sorted(set(row[c] or []))
        name = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>")
        # the number of bounds up to the value, by binary search
        steps = F.array(*(F.lit(1 << b) for b in reversed(range(bits))))
        # a column of few values is spread over all bits, or the others would decide the order alone
        spread = F.floor(_upto(name, as_double[c], steps) * F.lit(cuts) / F.lit(len(bounds) + 1)).cast("int")
        ranks.append(F.coalesce(spread, F.lit(0)))
    keyed = df.withColumns({f"_r{i}": r for i, r in enumerate(ranks)})
    keyed = keyed.withColumn("_z", z_value([F.col(f"_r{i}") for i in range(len(columns))], bits))
    return keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").select(*df.columns)


def files_with(df: DataFrame, condition: Column) -> DataFrame:
    """(rows, files_hit, files): how many files of a stored table hold rows of ``condition``."""
    per = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count_if(condition).alias("hits"))
    return per.agg(F.sum("hits").alias("rows"), F.count_if(F.col("hits") > 0).alias("files_hit"), F.count(F.lit(1)).alias("files"))
