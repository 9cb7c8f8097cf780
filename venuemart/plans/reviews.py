"""Review texts to features, dish mentions and sentiment per dish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuemart.functions.scores import polarity
from venuemart.functions.text import clean_text, map_values_of, not_blank
from venuemart.lexicons import DISH_LEMMAS, SCORE_LABELS, SENTIMENT_LABELS
from venuemart.operators.mentions import find_mentions, lemmatise
from venuemart.operators.stats import boxcox_scale

SENTENCE_KEYS = ["global_id", "sentence_id"]
MENTION_FEATURES = ["source", "url", *SCORE_LABELS]


def text_features(
    df: DataFrame,
    text: str,
    lemmas: DataFrame | None = None,
    scorer: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Add `{text}_standard` (clean), `{text}_norm` (lemmas) and one score per label.

    `scorer(df, column)` adds score columns; labels it does not give are 0. Without a lemma table the clean
    text stands for the lemmas.
    """
    standard, norm = f"{text}_standard", f"{text}_norm"
    out = df.withColumn(standard, clean_text(F.col(text)))
    if lemmas is None:
        out = out.withColumn(norm, F.col(standard))
    else:
        out = lemmatise(out, standard, lemmas, norm)
    if scorer is not None:
        out = scorer(out, standard)
    missing = {label: F.lit(0.0) for label in SCORE_LABELS if label not in out.columns}
    return out.withColumns(missing) if missing else out


def dish_mentions(
    sentences: DataFrame, text: str, keys: list[str] = SENTENCE_KEYS, features: list[str] = MENTION_FEATURES,
    lexicon: dict[str, str] | DataFrame = DISH_LEMMAS,
) -> DataFrame:
    """Dish mentions of each sentence (ids, aspect, value, count) with the sentence's features."""
    return find_mentions(sentences, text, keys, features, lexicon)


def with_polarity(df: DataFrame, out: str = "sentiment", scaled: bool = True) -> DataFrame:
    """Polarity of the label scores; by default Box-Cox transformed and scaled over the whole table."""
    if not scaled:
        return df.withColumn(out, polarity())
    return boxcox_scale(df.withColumn("_polarity", polarity()), "_polarity", out, add_one=True).drop("_polarity")


def named_aspects(mentions: DataFrame, scaled: str | None = "before") -> DataFrame:
    """Mean sentiment and mentions per venue, aspect and value.

    Sentiment is the polarity of the scores, Box-Cox transformed and scaled over all mentions `before` the
    means are taken, or over all means `after`, or not at all (None).
    """
    if scaled not in ("before", "after", None):
        raise ValueError(f"scaled must be 'before', 'after' or None, not {scaled!r}")
    keys = ["global_id", "aspect", "value"]
    means = (
        with_polarity(mentions, scaled=scaled == "before")
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.avg("sentiment").alias("sentiment"), F.sum("count").alias("count"))
    )
    if scaled != "after":
        return means
    renamed = means.withColumnRenamed("sentiment", "_mean")
    return boxcox_scale(renamed, "_mean", "sentiment", add_one=True).select(*means.columns)


def venue_ratings(stars: DataFrame, scaled: bool = False) -> DataFrame:
    """Mean over sources (`fname`) of the mean rating per venue and source.

    `scaled` adds the same mean over the ratings transformed and scaled per source.
    """
    keys = ["global_id", "fname"]
    per_file = stars.dropna(subset=keys).groupBy(*keys).agg(F.avg("rating").alias("rating"))
    means = [F.avg("rating").alias("rating")]
    if scaled:
        per_file = boxcox_scale(per_file, "rating", "rating_boxcox_scaled", groups=["fname"])
        means.append(F.avg("rating_boxcox_scaled").alias("rating_boxcox_scaled"))
    return per_file.groupBy("global_id").agg(*means)


def training_set(labelled: DataFrame, dataset: str) -> DataFrame:
    """Cleaned labelled texts: sentiment as -1, 0 or 1 (NULL if the label is unknown), blank texts dropped."""
    if dataset not in SENTIMENT_LABELS:
        raise ValueError(f"unknown dataset {dataset!r}, expected one of {sorted(SENTIMENT_LABELS)}")
    label = map_values_of(F.col("sentiment").cast("string"), SENTIMENT_LABELS[dataset])
    # The test of the generated column does not clean the text once more, as that of a projected one would.
    new = {"sentiment": label.cast("int"), "review": F.explode_outer(F.array(clean_text(F.col("review"))))}
    clean = labelled.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in labelled.columns])
    return clean.where(not_blank(F.col("review")))
