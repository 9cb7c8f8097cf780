"""Lemmas of unknown words by suffix rules that a lemma table teaches.

A pair (token, lemma) shares a stem, the longest beginning of both. What follows the stem in the token is cut off, and
what follows it in the lemma is put on. Each pair votes for this change under the suffixes of the token that hold
the cut part and up to three letters of the stem before it; a suffix's rule is the change with the most votes. An
unknown word takes the rule of its longest known suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.functions.text import tokens
from venuemart.operators.skew import lookup_join

#: Letters of the stem that a rule's suffix may hold.
CONTEXT = 3
#: Letters of the longest suffix that rules are kept for.
LONGEST = 12


def _stem_length(a: Column, b: Column) -> Column:
    """Length of the longest common beginning."""
    places = F.sequence(F.lit(1), F.least(F.length(a), F.length(b)))
    # Text functions take columns as positions only in SQL form; a place in a lambda is one.
    same = F.filter(places, lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.when(F.least(F.length(a), F.length(b)) > 0, F.size(same)).otherwise(F.lit(0))


def suffix_rules(lemmas: DataFrame, context: int = CONTEXT, longest: int = LONGEST) -> DataFrame:
    """(suffix, cut, ending, votes): for each suffix the change that most pairs of `lemmas` (token, lemma) make.

    Of changes with as many votes the one that cuts less wins, then the first ending. Pairs with a null, and
    empty tokens, teach nothing; a repeated pair votes once.
    """
    pairs = lemmas.select("token", "lemma").where("token != '' AND lemma IS NOT NULL").distinct()
    stemmed = pairs.withColumn("_stem", _stem_length(F.col("token"), F.col("lemma")))
    changed = stemmed.select(
        "token", (F.length("token") - F.col("_stem")).alias("cut"), F.substr("lemma", F.col("_stem") + 1).alias("ending")
    )
    lengths = F.sequence(F.greatest(F.col("cut"), F.lit(1)), F.least(F.col("cut") + context, F.length("token")))
    suffixes = changed.where(F.greatest("cut", F.lit(1)) <= longest).select("cut", "ending", "token", F.explode(lengths).alias("_n")).where(F.col("_n") <= longest)
    votes = suffixes.groupBy(F.expr("right(token, _n)").alias("suffix"), "cut", "ending").agg(F.count(F.lit(1)).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("votes"), "cut", "ending")).alias("_best")
    return votes.groupBy("suffix").agg(best).select("suffix", "_best.cut", "_best.ending", (-F.col("_best.votes")).alias("votes"))


def apply_rules(words: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(token, lemma) for each distinct token of `words` that a rule fits."""
    found = words.select("token").where("token != ''").distinct()
    lengths = F.sequence(F.lit(1), F.least(F.length("token"), F.lit(longest)))
    asked = found.select("token", F.explode(lengths).alias("_n")).withColumn("suffix", F.expr("right(token, _n)"))
    met = lookup_join(asked, rules.select("suffix", "cut", "ending"), ["suffix"])
    best = met.groupBy("token").agg(F.max_by(F.struct("cut", "ending"), "_n").alias("_rule"))
    lemma = F.concat(F.expr("left(token, length(token) - _rule.cut)"), F.col("_rule.ending"))
    return best.select("token", lemma.alias("lemma"))


def with_unknown(df: DataFrame, text: str, lemmas: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """The lemma table for the words of `df`: known ones from `lemmas`, others by `rules` (by default those of `lemmas`)."""
    rules = suffix_rules(lemmas) if rules is None else rules
    words = df.select(F.explode(tokens(F.col(text))).alias("token")).distinct()
    unknown = words.join(lemmas.select("token").where("token IS NOT NULL"), "token", "left_anti")
    return lemmas.select("token", "lemma").where("token IS NOT NULL AND lemma IS NOT NULL").union(apply_rules(unknown, rules))
