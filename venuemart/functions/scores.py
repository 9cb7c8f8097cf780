"""Label scores of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuemart.lexicons import POLARITY, SCORE_LABELS


def polarity(labels: list[str] = SCORE_LABELS, weights: dict[str, int] = POLARITY) -> Column:
    """Weighted softmax of the label scores: share of positive minus share of negative."""
    top = F.greatest(*[F.col(name) for name in labels])
    exps = {name: F.exp(F.col(name) - top) for name in labels}
    missing = F.lit(False)
    total = F.lit(0.0)
    for name in labels:
        missing = missing | F.col(name).isNull()
        total = total + exps[name]
    signed = F.lit(0.0)
    for name, weight in weights.items():
        signed = signed + F.lit(float(weight)) * exps[name]
    return F.when(~missing, F.try_divide(signed, total))


def top_labels(labels: list[str], k: int) -> Column:
    """The k best labels of a row as `array<struct<score,label>>`, ties by label name."""
    pairs = F.array(*[F.struct((-F.col(n)).alias("neg"), F.lit(n).alias("label")) for n in labels])
    best = F.slice(F.array_sort(pairs), 1, k)
    return F.transform(best, lambda p: F.struct((-p["neg"]).alias("score"), p["label"].alias("label")))
