"""Choices that the queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.llm import pieces

#: The vocabulary of op7 and the pipeline; any SentencePiece model file serves.
PIECES = "piece_bpe_32k.model"


def held_out(column: str = "doc_id") -> Column:
    """Rows whose labels are for evaluation alone."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(5)) == 0


def graded(labels: DataFrame) -> DataFrame:
    """Ratings in three grades: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, F.lit(2) - F.col("toxic")).otherwise(0).alias("grade"))


def vocabulary(path: str | None = None) -> pieces.Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(PIECES)
    return pieces.load(path)
