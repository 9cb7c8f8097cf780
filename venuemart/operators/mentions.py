"""Dish mentions and lemmas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.functions.text import BLANK, tokens
from venuemart.lexicons import DISH_LEMMAS
from venuemart.operators.skew import lookup_join
from venuemart.session import use_checkpoints

# Words that are looked for before the tokens are counted; a longer lexicon is met by the counted tokens alone.
FILTERED_WORDS = 1000
# Lemmas that are written into the expression.
LITERAL_LEMMAS = 256


def token_counts(words: Column) -> Column:
    """Distinct elements of an array with their number, array<struct<token, count>>, in one sorted pass."""
    ordered = F.sort_array(words)
    size = F.size(words)
    starts = lambda s: F.filter(
        F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
    )
    runs = lambda s, p: F.transform(
        p, lambda at, k: F.struct(F.get(s, at).alias("token"), (F.coalesce(F.get(p, k + 1), size) - at).cast("long").alias("count"))
    )
    # An array of one element binds its value to a name, so that lambdas do not sort once per element.
    bound = F.transform(F.array(ordered), lambda s: F.element_at(F.transform(F.array(starts(s)), lambda p: runs(s, p)), 1))
    return F.when(size > 0, F.element_at(bound, 1))


def find_mentions(
    df: DataFrame,
    text: str,
    keys: list[str],
    features: list[str] | None = None,
    lexicon: dict[str, str] | DataFrame = DISH_LEMMAS,
    aspect: str = "dish",
) -> DataFrame:
    """How often each lexicon word occurs in a row's tokens: keys, aspect, value, count and the features.

    `lexicon` maps a lemma to the value reported, as a dict or as a table (lemma, value; lemmas unique). A row
    gives one mention per lemma it holds, also where lemmas share a value. Tokens are counted inside the row;
    the counts meet the lexicon in a join that sends a small one to every task.
    """
    features = features or []
    spark = df.sparkSession
    found = F.split(F.col(text), f"(?U){BLANK}+")
    if isinstance(lexicon, dict):
        if len(lexicon) <= FILTERED_WORDS:
            words = list(lexicon)
            found = F.filter(found, lambda t: t.isin(words))
        lexicon = spark.createDataFrame(list(lexicon.items()), "lemma string, value string")
    hits = df.select(*keys, *features, found.alias("_hits"))
    # The outer explode keeps Spark from testing the array, and so computing it, once more beforehand.
    counted = hits.select(*keys, *features, F.explode_outer(token_counts(F.col("_hits"))).alias("_m")).where("_m is not null")
    counted = counted.select(*keys, *features, F.col("_m.token").alias("lemma"), F.col("_m.count").alias("count"))
    met = lookup_join(counted, lexicon.select("lemma", "value"), ["lemma"])
    return met.select(*keys, F.lit(aspect).alias("aspect"), "value", "count", *features)


def with_features(mentions: DataFrame, df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Left join of row features to mentions; a repeated key multiplies its mentions."""
    if not features:
        return mentions
    return mentions.join(df.select(*keys, *features), keys, "left").select(*mentions.columns, *features)


def lemmatise(df: DataFrame, text: str, lemmas: DataFrame, out: str, rows: int = LITERAL_LEMMAS) -> DataFrame:
    """Replace every token by its lemma; unknown tokens stay (`lemmas.with_unknown` adds lemmas for them).

    `lemmas` is a table (token, lemma); a token given twice has the smallest of its lemmas. Up to `rows` of them
    become part of the expression, and texts stay where they are. A larger table meets the tokens in a join, sent
    to every task if it is measured to be small; they are put together again by a row number, so no column of
    `df` needs to be a key.
    """
    held = lemmas.where("token IS NOT NULL AND lemma IS NOT NULL").groupBy("token").agg(F.min("lemma").alias("lemma"))
    small = held.limit(rows + 1).collect()
    if len(small) <= rows:
        known = F.create_map(*[F.lit(x) for r in small for x in (r.token, r.lemma)]) if small else None
        names = [r.token for r in small]
        # The set is hashed; the map is searched for words in it only.
        rewrite = lambda t: F.when(t.isin(names), known[t]).otherwise(t)
        words = tokens(F.col(text))
        return df.withColumn(out, F.array_join(F.transform(words, rewrite) if small else words, " "))
    use_checkpoints(df.sparkSession)
    rows_of = df.withColumn("_rid", F.monotonically_increasing_id()).checkpoint()
    words = rows_of.select("_rid", F.posexplode(tokens(F.col(text))).alias("_pos", "token"))
    looked_up = lookup_join(words, held, ["token"], "left")
    order = F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("lemma", "token").alias("w"))))
    rewritten = looked_up.groupBy("_rid").agg(F.array_join(F.transform(order, lambda p: p["w"]), " ").alias("_lemmas"))
    # A text without tokens has no group: NULL stays NULL, blank becomes empty.
    return (
        rows_of.join(rewritten, "_rid", "left")
        .withColumn(out, F.when(F.col(text).isNotNull(), F.coalesce("_lemmas", F.lit(""))))
        .drop("_lemmas", "_rid")
    )


def lemmatise_with(df: DataFrame, text: str, normal_form, out: str) -> DataFrame:
    """Same with a caller's `normal_form(token) -> lemma`, run in Arrow batches; each distinct token once a batch."""
    @F.pandas_udf("array<string>")
    def run(batches: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def lemma(token: str) -> str:
            if token not in known:
                known[token] = normal_form(token)
            return known[token]

        return batches.map(lambda words: None if words is None else [lemma(w) for w in words])

    return df.withColumn(out, F.array_join(run(tokens(F.col(text))), " "))
