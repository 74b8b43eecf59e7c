"""Type inference classifies each text once, with the types that counts of each form give."""

from pyspark.sql import functions as F

from kestrel.operators import drift as D

TEXTS = ["1", "-7", "+5", "000000000001", "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807",
         "9223372036854775808", "99999999999999999999", "1.5", ".5", "5.", ".", "1e5", "-1E-3", "1e", "2024-02-29", "2023-02-29",
         "2024-2-9", "+", "-", ",1", "/", ":", "\t12", "12\t", "1\n", "٣", "x", "no-at-sign", "NaN", "  ", "", None, " 42 ", "1 2"]


def types_by_counts(spark, columns):
    """The type of each column by counts of each form, every pattern and cast tried on every text."""
    v = F.trim(F.col("v"))
    present, as_long = v.isNotNull() & (v != ""), v.try_cast("long")
    counts = spark.createDataFrame([(f"c{i}", t) for i, c in enumerate(columns) for t in c], "c string, v string").groupBy("c").agg(
        F.count_if(present), F.count_if(present & v.rlike(D.INT_RE) & as_long.between(-2**31, 2**31 - 1)),
        F.count_if(present & v.rlike(D.INT_RE) & as_long.isNotNull()), F.count_if(present & v.rlike(D.DEC_RE)),
        F.count_if(present & v.rlike(D.DATE_RE) & v.try_cast("date").isNotNull())).collect()
    names = ["IntegerType()", "LongType()", "DoubleType()", "DateType()"]
    return {r[0]: next((t for t, n in zip(names, r[2:], strict=True) if r[1] and n == r[1]), "StringType()") for r in counts}


def test_inferred_types_equal_those_by_counts(spark):
    """Odd texts as columns, alone and beside another type, in one aggregate."""
    columns = [[t, None] for t in TEXTS] + [["1", "2147483648"], ["1", "1.5"], ["9223372036854775807", "1e5"], ["2024-01-01", "3"]]
    rows = [tuple(c[k] for c in columns) for k in range(2)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(columns))))
    assert {r["column_name"]: r["data_type"] for r in D.infer_types(df, "t").collect()} == types_by_counts(spark, columns)
    assert D.infer_types(df.select("c0").limit(0), "t").first()["data_type"] == "StringType()"


def test_inference_is_one_aggregate_a_column(spark):
    """a text is classified once, and a cast that would raise on every text is not tried."""
    df = spark.createDataFrame([("C001", "7")], "a string, b string")
    plan = D.infer_types(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or(") == 2 and "count(" not in plan
