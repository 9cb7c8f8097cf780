"""A training corpus in five stages: quality, repeated lines, near-duplicates, source mix, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.llm import line_dedup, mixing, pieces, quality, simhash
from venuemart.llm.common import mark, read_table, release, stored
from venuemart.llm.recipe import graded, held_out, vocabulary

#: The classifier decides by a fitted model, the mix by seeded draws: no SQL gives the same rows.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that more likely than not are of grade 1 or better; the others go."""
    model = quality.fit(docs, graded(read_table(spark, sf_dir, "labels").where(~held_out())))
    return quality.score(docs, model, least=1.0).where("tail >= 0.5").select("row.*")


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them hold; `n_chars` is that of the new text."""
    cut = line_dedup.drop_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.one_per_group(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it."""
    return pieces.encode_and_decode(docs, vocabulary())


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", own_lines),
    ("SimHash near-dedup", distinct_documents),
    ("mixing sources to target weights", mixed_documents),
    ("SentencePiece encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Each result is written to the shared folder and read again; the tables a
    stage kept for itself are deleted then."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = mark()
        made = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        release(spark, before, mark() - 1)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
