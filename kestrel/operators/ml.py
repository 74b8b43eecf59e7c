"""Customer labelling and models with Spark ML (no driver-side pandas).

The reference pulls the gold table into pandas and fits scikit-learn on the
driver; here features, split, training, scoring and metrics stay
distributed: ``VectorAssembler`` + ``RandomForestClassifier`` /
``RandomForestRegressor`` inside a ``Pipeline``, metrics as aggregates.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ["total_spend", "total_orders", "avg_order_value"]
LABEL = "is_high_value"


def label_high_value(gold_sales: DataFrame, spend: float = 5000, aov: float = 200) -> DataFrame:
    """Label, the three features, rows with any null dropped."""
    lab = F.when((F.col("total_spend") >= spend) | (F.col("avg_order_value") >= aov), 1).otherwise(0)
    return (gold_sales.withColumn(LABEL, lab.cast("int"))
            .select("customer_id", *FEATURES, LABEL).na.drop(subset=FEATURES + [LABEL]))


def split_flag(key: Column, train_pct: int = 80, seed: int = 42) -> Column:
    """M2: stable train flag from the MD5 of ``key:seed`` (independent of partitioning, and other engines can repeat it)."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < train_pct


def train_test_split(df: DataFrame, key: str = "customer_id", train_pct: int = 80, seed: int = 42):
    flag = split_flag(F.col(key), train_pct, seed)
    return df.filter(flag), df.filter(~flag)


def classifier_pipeline(trees: int = 100, depth: int = 8, seed: int = 42) -> Pipeline:
    """M3: assembler + random forest (100 trees, depth 8, seed 42)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed),
    ])


def classification_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Accuracy and F1 (positive class 1) from one aggregate of TP/FP/FN/TN."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    m = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    f1_den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return m.select("tp", "fp", "fn", "tn", n.alias("n"),
                    F.when(n > 0, (F.col("tp") + F.col("tn")) / n).alias("accuracy"),
                    F.when(f1_den > 0, 2 * F.col("tp") / f1_den).otherwise(F.lit(0.0)).alias("f1"))


def fit_classifier(labelled: DataFrame, **kw) -> PipelineModel:
    return classifier_pipeline(**kw).fit(labelled)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch (or streaming) scoring; works on a streaming DataFrame too.

    Every row stays; one with a null feature has a null prediction.
    """
    known = F.lit(True)
    for c in FEATURES:
        known = known & F.col(c).isNotNull()
    return model.transform(df).select(*df.columns, F.when(known, F.col("prediction").cast("int")).alias("prediction"))


def midpoint_predictions(train: DataFrame, test: DataFrame, feature: str = "total_spend") -> DataFrame:
    """``test`` with ``prediction``: 1 above the middle of the two classes' training means of one feature.

    The simple model that the forest is held against.  The middle is one row, so its broadcast has a proven size.
    Where only one class has training rows, that class is predicted; without any the prediction is null.
    """
    y = F.col(LABEL)
    middle = train.agg(((F.avg(F.when(y == 1, F.col(feature))) + F.avg(F.when(y == 0, F.col(feature)))) / 2).alias("_middle"),
                       F.max(y).alias("_only"))
    return test.crossJoin(F.broadcast(middle)).withColumn(
        "prediction", F.coalesce((F.col(feature) >= F.col("_middle")).cast("int"), F.col("_only"))).drop("_middle", "_only")


# ---------------------------------------------------------------- M6 / A19
DATE_FEATURES = ["total_orders", "avg_order_value", "first_purchase_day", "last_purchase_day", "active_days"]


def regression_features(gold_sales: DataFrame) -> DataFrame:
    """dates as day numbers; target total_spend kept out of the features."""
    epoch = F.lit("1970-01-01").cast("date")
    return gold_sales.select(
        "customer_id", F.col("total_spend").cast("double").alias("total_spend"), "total_orders", "avg_order_value",
        F.datediff("first_purchase_date", epoch).alias("first_purchase_day"),
        F.datediff("last_purchase_date", epoch).alias("last_purchase_day"),
        F.datediff("last_purchase_date", "first_purchase_date").alias("active_days"),
    ).na.drop()


def regressor_pipeline(trees: int = 100, depth: int = 8, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=DATE_FEATURES, outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(featuresCol="features", labelCol="total_spend", numTrees=trees, maxDepth=depth,
                              seed=seed),
    ])


def regression_metrics(pred: DataFrame, label: str = "total_spend", prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE, R^2 in one aggregate."""
    e = F.col(prediction) - F.col(label)
    y = F.col(label)
    m = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.sum(e * e).alias("sse"), F.var_pop(y).alias("variance"))
    sst = F.col("variance") * F.col("n")  # var_pop updates centred moments: no cancellation
    return m.select("n", "mae", F.sqrt("mse").alias("rmse"),
                    F.when(sst > 0, 1 - F.col("sse") / sst).alias("r2"))


def ratio_predictions(train: DataFrame, test: DataFrame, target: str = "total_spend", size: str = "total_orders") -> DataFrame:
    """``test`` with ``prediction``: ``size`` times the training rows' target per unit of size (null without training rows)."""
    ratio = train.agg((F.sum(target) / F.sum(size)).alias("_ratio"))
    return test.crossJoin(F.broadcast(ratio)).withColumn("prediction", F.col("_ratio") * F.col(size)).drop("_ratio")


def feature_importances(model: PipelineModel, names: list[str]) -> list[tuple[str, float]]:
    """M7: (feature, importance) of the fitted forest (model metadata, tiny)."""
    imp = model.stages[-1].featureImportances
    return [(n, float(imp[i])) for i, n in enumerate(names)]


def save_model(model: PipelineModel, path: str) -> None:
    """M7: persist the fitted pipeline (shared storage; no pickle)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M7: reload a fitted pipeline for batch or streaming scoring."""
    return PipelineModel.load(path)
