"""Classification metrics from the confusion counts."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class; only class counts are shuffled."""
    pairs = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    # Each pair counts for the class it has and for the class it was given.
    sides = F.array(
        F.struct(F.col(label).alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("given")),
        F.struct(F.col(prediction).alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("given")),
    )
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    per_class = (
        pairs.select(hit.alias("hit"), F.inline(sides))
        .groupBy("class")
        .agg(
            F.sum(F.when(F.col("actual") > 0, F.col("hit")).otherwise(0)).alias("hits"),
            F.sum("actual").alias("support"),
            F.sum("given").alias("predicted"),
        )
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0))
    return per_class.select(
        F.col("class"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: macro_f1 and accuracy."""
    report = classification_report(df, label, prediction)
    return report.agg(
        F.avg("f1").alias("macro_f1"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
    )


def compare(predictions: dict[str, DataFrame], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """macro_f1 and accuracy per named model."""
    out = None
    for name, df in predictions.items():
        row = summary(df, label, prediction).select(F.lit(name).alias("model"), "macro_f1", "accuracy")
        out = row if out is None else out.unionByName(row)
    return out


class MacroF1(Evaluator):
    """Unweighted mean of the F1 of all classes (the built-in `f1` weighs by support)."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(summary(dataset).first()["macro_f1"])

    def isLargerBetter(self) -> bool:
        return True
