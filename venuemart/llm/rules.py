"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's histograms of character classes and of common words are compared with those of its language by the
Jensen-Shannon distance (0 to 1). The references are the means over all documents of the language that pass the
base rules, long and short ones alike. Each is drawn towards the mean of all languages, as if the language had
`POOLED` more documents like it: a language of few documents is judged by all, one of many by its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart.llm.common import SPACE_RUN, packed, stored, text_of

# Ten common words of each of four languages; words of several languages are listed once.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des",
    "de", "la", "le", "et", "les", "un", "est", "que", "pour", "dans",
    "el", "y", "los", "se", "las", "por", "con", "una", "para", "del",
]

#: A document shorter than this is rejected by the base rule, and no part of the references.
LEAST_WORDS = 50
#: A document needs so many words for its common words to be judged.
WORDS_FOR_COMMON = 100
#: Documents like the mean of all languages that each language's reference counts besides its own.
POOLED = 3
#: Distances from which a document is rejected.
CLASSES_APART = 0.25
COMMON_APART = 0.27

# Words of three-word windows that occur twice or more. The names w, h, s bind an array once, so that lambdas
# do not evaluate it for every element. Windows are told apart by a 64-bit hash of their words.
REPEATED = """
CASE WHEN size(words) < 3 THEN 0 ELSE element_at(transform(array(words), w ->
  element_at(transform(array(transform(sequence(1, size(w) - 2), i -> xxhash64(w[i - 1], w[i], w[i + 1]))), h ->
    CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE
      element_at(transform(array(sort_array(transform(h, (x, i) -> struct(x, i)))), s ->
        size(array_distinct(flatten(transform(
          filter(s, (e, k) -> (k > 0 AND s[k - 1].x = e.x) OR (k < size(s) - 1 AND s[k + 1].x = e.x)),
          e -> array(e.i, e.i + 1, e.i + 2)))))), 1) END), 1)), 1) END"""


def _length(column: str) -> Column:
    return F.char_length(column).cast("bigint")


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of docs as struct `row`, with lang, the counts of the base rules, and both histograms."""
    df = packed(docs, lang=F.col(lang_col).cast("string"), text=text_of(text_col))
    df = df.withColumn("words", F.filter(F.split("text", SPACE_RUN), lambda w: w != ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    # Each step takes one class of characters away; the lengths between the steps count it.
    steps = [SPACE_RUN, r"\p{Ll}+", r"\p{Lu}+", r"\p{Nd}+", r"""[.,;:!?'"()-]+""", r"[#*$%&|<>]+"]
    df = df.withColumn("s0", F.col("text"))
    for k, pattern in enumerate(steps):
        df = df.withColumn(f"s{k + 1}", F.regexp_replace(f"s{k}", pattern, ""))
    classes = [_length(f"s{k}") - _length(f"s{k + 1}") for k in range(len(steps))] + [_length(f"s{len(steps)}")]
    n_words = F.size("words").cast("bigint")
    df = df.withColumn("common", F.filter("words", lambda w: w.isin(*COMMON_WORDS)))
    each = [(F.size("common") - F.size(F.array_remove("common", w))).cast("bigint") for w in COMMON_WORDS]
    return df.select(
        "row", "lang", n_words.alias("n_words"), _length("s1").alias("word_chars"), classes[5].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(REPEATED).cast("bigint").alias("n_repeat_words"),
        F.array(*classes).alias("classes"), F.array(*each, n_words - F.size("common")).alias("common"),
    )


def distance(mine: Column, other: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares; null if one of them is."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(mine, other, lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0).cast("double"), lambda a, x: a + x), F.lit(0.0)))


def shares(column: str) -> Column:
    total = F.aggregate(column, F.lit(0).cast("double"), lambda a, v: a + v)
    return F.when(total > 0, F.element_at(F.transform(F.array(total), lambda t: F.transform(column, lambda v: v / t)), 1))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", classes_apart: float = CLASSES_APART, common_apart: float = COMMON_APART) -> DataFrame:
    """Rows of docs as struct `row`, with the base counts, both distances, base_failed and kept.

    A document is kept unless a base rule or a distance rejects it. A distance is null, and rejects nothing, if
    the document is shorter than its guard; there is no such guard for languages. Null text has no words and
    fails; documents of null language are a language. Repeated rows count in the references as often as they
    occur. Other columns pass through whatever their names.
    """
    held = stored(counted(docs, text_col, lang_col), "counts")
    n = {c: len(v) for c, v in (("classes", [0] * 7), ("common", [*COMMON_WORDS, ""]))}
    # Shares in whole millionths: their sums do not depend on the order of the rows.
    sums = [F.array(*[F.sum(F.get(f"{c}_in", F.lit(k))) for k in range(n[c])]).alias(f"{c}_of") for c in n]
    long = held.where(~base_failed()).withColumns({f"{c}_in": F.transform(shares(c), lambda v: F.floor(v * 1e6)) for c in n})
    refs = long.groupBy(F.col("lang").alias("ref")).agg(F.count(F.lit(1)).alias("docs"), *sums)
    refs = stored(refs, "references")
    pool = refs.agg(F.sum("docs").alias("docs"), *[F.array(*[F.sum(F.get(f"{c}_of", F.lit(k))) for k in range(n[c])]).alias(c) for c in n]).first()
    # A document that passes the base rules has at least itself in the sums; without one nothing is compared.
    mean = {c: F.array(*[F.lit(POOLED * (v or 0) / (pool.docs or 1)) for v in pool[c]]) for c in n}
    refs = refs.select("ref", *[F.zip_with(f"{c}_of", mean[c], lambda own, rest: own + rest).alias(f"{c}_of") for c in n])
    met = held.join(refs, F.col("lang").eqNullSafe(F.col("ref")), "left")
    for c in n:
        met = met.withColumn(c, shares(c)).withColumn(f"{c}_of", shares(f"{c}_of"))
    apart = {c: F.when(F.col("n_words") >= least, distance(F.col(c), F.col(f"{c}_of"))) for c, least in (("classes", LEAST_WORDS), ("common", WORDS_FOR_COMMON))}
    failed = base_failed()
    out = met.withColumn("base_failed", failed).withColumn("class_distance", apart["classes"]).withColumn("word_distance", apart["common"])
    fine = (F.coalesce("class_distance", F.lit(0.0)) < classes_apart) & (F.coalesce("word_distance", F.lit(0.0)) < common_apart)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("row", *counts, "base_failed", (~failed & fine).alias("kept"), "class_distance", "word_distance")
