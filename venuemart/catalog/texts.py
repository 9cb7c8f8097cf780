"""Text, mention and score queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.catalog import query, table
from venuemart.catalog import sqltext as sql
from venuemart.functions import scores, text, urls
from venuemart.operators import ids, mentions, stats
from venuemart.operators import lemmas as lemma_rules_of
from venuemart.plans import listing, reviews

# Frequent words of the test texts stand in for dishes and for inflected forms.
WORDS = {
    "the": "the", "of": "of", "that": "that", "le": "le", "que": "que", "des": "des", "der": "der", "und": "und",
    "los": "los", "por": "por", "with": "with", "est": "est", "of.": "of", "thand": "and",
}
LEMMAS = [
    ("are", "be"), ("is", "be"), ("was", "be"), ("une", "un"), ("les", "le"), ("la", "le"), ("des", "de"),
    ("du", "de"), ("die", "der"), ("das", "der"), ("los", "el"), ("las", "el"),
]


def rounded(c, digits: int):
    return F.round(c, digits) + F.lit(0.0)


def _values(pairs) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


@query(f"SELECT doc_id, {sql.clean('text')} AS clean FROM documents")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("clean"))


@query(
    f"SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens "
    f"FROM (SELECT doc_id, {sql.tokens('text')} AS t FROM documents)"
)
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = text.tokens(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(words).cast("long").alias("n_tokens"), F.array_join(words, "|").alias("tokens")
    )


_SENTENCES = (
    "SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, s AS sentence FROM (SELECT doc_id, unnest(p) AS s, "
    "generate_subscripts(p, 1) AS pos FROM (SELECT doc_id, string_split(text, '.') AS p FROM documents)) "
    f"WHERE regexp_matches(s, '{sql.NOT_BLANK}')"
)


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("sentence"))
    return listing.split_sentences(docs, "sentence").select("doc_id", F.col("pos").cast("long").alias("pos"), "sentence")


@query(_SENTENCES)
def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    return _sentences(spark, sf)


@query(
    "SELECT doc_id AS global_id, sentence AS review, concat('https://reviews.example.org/', doc_id) AS url, "
    "'https://reviews.example.org/' AS source, "
    f"row_number() OVER (ORDER BY doc_id, pos) - 1 AS sentence_id FROM ({_SENTENCES})"
)
def sentence_ids(spark: SparkSession, sf: str) -> DataFrame:
    site = "https://reviews.example.org/"
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("global_id"), F.col("text").alias("review"), F.concat(F.lit(site), "doc_id").alias("url")
    )
    return listing.review_sentences(docs, site)


_MENTIONS = (
    f"SELECT doc_id, pos, 'dish' AS aspect, value, count(*) AS count FROM (SELECT doc_id, pos, "
    f"unnest(string_split({sql.clean('sentence')}, ' ')) AS t FROM ({_SENTENCES})) JOIN "
    f"(VALUES {_values(WORDS.items())}) w(lemma, value) ON t = lemma GROUP BY doc_id, pos, lemma, value"
)


@query(_MENTIONS)
def dish_mentions(spark: SparkSession, sf: str) -> DataFrame:
    clean = _sentences(spark, sf).withColumn("norm", text.clean_text(F.col("sentence")))
    return mentions.find_mentions(clean, "norm", ["doc_id", "pos"], lexicon=WORDS)


@query(_MENTIONS)
def dish_mentions_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a lexicon table."""
    clean = _sentences(spark, sf).withColumn("norm", text.clean_text(F.col("sentence")))
    lexicon = spark.createDataFrame(list(WORDS.items()), "lemma string, value string")
    return mentions.find_mentions(clean, "norm", ["doc_id", "pos"], lexicon=lexicon)


def _aliased(n: int) -> list[tuple[str, str]]:
    """A lexicon of n lemmas, three to a value; the words of the test texts come first."""
    words = [*WORDS, *(f"unseen{k}" for k in range(n - len(WORDS)))]
    return [(w, f"value{k // 3}") for k, w in enumerate(words)]


@query(
    " UNION ALL ".join(
        f"SELECT {n} AS words, doc_id, pos, value, count(*) AS count FROM (SELECT doc_id, pos, unnest(string_split({sql.clean('sentence')}, ' ')) AS t "
        f"FROM ({_SENTENCES})) JOIN (VALUES {_values(_aliased(n))}) w(lemma, value) ON t = lemma GROUP BY doc_id, pos, lemma, value"
        for n in (29, 600, 1001)
    )
)
def dish_mentions_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Lemmas that share a value are counted apart, whatever the size of the lexicon."""
    clean = _sentences(spark, sf).withColumn("norm", text.clean_text(F.col("sentence")))
    out = None
    for n in (29, 600, 1001):
        found = mentions.find_mentions(clean, "norm", ["doc_id", "pos"], lexicon=dict(_aliased(n)))
        found = found.select(F.lit(n).alias("words"), "doc_id", "pos", "value", "count")
        out = found if out is None else out.union(found)
    return out


@query(f"SELECT m.*, d.source, d.lang FROM ({_MENTIONS}) m LEFT JOIN documents d USING (doc_id)")
def mentions_with_features(spark: SparkSession, sf: str) -> DataFrame:
    clean = _sentences(spark, sf).withColumn("norm", text.clean_text(F.col("sentence")))
    found = mentions.find_mentions(clean, "norm", ["doc_id", "pos"], lexicon=WORDS)
    return mentions.with_features(found, table(spark, sf, "documents"), ["doc_id"], ["source", "lang"])


@query(
    f"SELECT nullif(doc_id % 7, 0) AS key, doc_id, array_to_string(list_transform(string_split({sql.clean('text')}, ' '), lambda t: CASE t "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEMMAS)
    + " ELSE t END), ' ') AS lemmas FROM documents"
)
def lemma_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Also rows whose key is NULL keep their text."""
    key = F.nullif(F.col("doc_id") % 7, F.lit(0)).alias("key")
    docs = table(spark, sf, "documents").select(key, "doc_id", text.clean_text(F.col("text")).alias("clean"))
    lemmas = spark.createDataFrame(LEMMAS, "token string, lemma string")
    return mentions.lemmatise(docs, "clean", lemmas, "lemmas").select("key", "doc_id", "lemmas")


# Endings of made-up inflections (token, lemma) by the last letter of a stem.
_ENDINGS = [("[aeiou]", "s", ""), ("[aeiou]", "d", ""), ("[lnrst]", "ings", "e"), ("[lnrst]", "ed", "e"), ("[^aeioulnrst]", "ies", "y"), ("[^aeioulnrst]", "ly", "")]


def _inflected(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs (token, lemma): every plain word of five letters and more, inflected; `held_out` is one in five."""
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))).alias("w")).distinct()
    every = F.array(*[F.struct(F.lit(a).alias("last"), F.lit(b).alias("token_end"), F.lit(c).alias("lemma_end")) for a, b, c in _ENDINGS])
    forms = words.select("w", F.inline(every))
    made = forms.where(F.expr("right(w, 1) RLIKE last"))
    return made.select(
        F.concat("w", "token_end").alias("token"), F.concat("w", "lemma_end").alias("lemma"), (F.substring(F.md5("w"), 1, 1) < "3").alias("held_out")
    ).distinct()


_INFLECTED = (
    r"words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS w FROM documents), "
    "pairs AS (SELECT DISTINCT w || te AS token, w || le AS lemma, md5(w)[1] < '3' AS held_out FROM words, (VALUES "
    + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _ENDINGS)
    + ") v(last, te, le) WHERE regexp_matches(w[-1], last)), "
    "stems AS (SELECT token, lemma, (SELECT count(*) FROM range(1, least(len(token), len(lemma)) + 1) r(i) WHERE token[1:i] = lemma[1:i]) AS stem FROM pairs WHERE NOT held_out), "
    "changes AS (SELECT token, len(token) - stem AS cut, lemma[stem + 1:] AS ending FROM stems), "
    f"votes AS (SELECT right(token, n) AS suffix, cut, ending, count(*) AS votes FROM (SELECT *, unnest(range(greatest(cut, 1), least(cut + {lemma_rules_of.CONTEXT}, len(token)) + 1)) AS n FROM changes) "
    f"WHERE n <= {lemma_rules_of.LONGEST} GROUP BY ALL), "
    "rules AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY suffix ORDER BY votes DESC, cut, ending) = 1)"
)


@query(f"WITH {_INFLECTED} SELECT suffix, cut, ending, votes FROM rules")
def lemma_rules(spark: SparkSession, sf: str) -> DataFrame:
    return lemma_rules_of.suffix_rules(_inflected(spark, sf).where("NOT held_out"))


@query(
    f"WITH {_INFLECTED}, asked AS (SELECT DISTINCT token FROM pairs WHERE held_out), "
    f"found AS (SELECT a.token, left(a.token, len(a.token) - cut) || ending AS guess FROM asked a, rules r WHERE suffix = right(a.token, len(suffix)) AND len(suffix) <= least(len(a.token), {lemma_rules_of.LONGEST}) "
    "QUALIFY row_number() OVER (PARTITION BY a.token ORDER BY len(suffix) DESC) = 1) "
    "SELECT p.token, p.lemma, guess, p.lemma = guess AS hit, (SELECT avg((x.lemma = y.guess)::INT) >= 0.9 FROM pairs x JOIN found y ON x.token = y.token WHERE x.held_out) AS nine_in_ten "
    "FROM pairs p JOIN found f ON p.token = f.token WHERE p.held_out"
)
def lemmas_of_unknown_words(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out pairs of the lemma table beside what the rules of the others make of their tokens."""
    pairs = _inflected(spark, sf)
    held = pairs.where("held_out").select("token", "lemma")
    guess = lemma_rules_of.apply_rules(held, lemma_rules_of.suffix_rules(pairs.where("NOT held_out"))).withColumnRenamed("lemma", "guess")
    out = held.join(guess, "token").withColumn("hit", F.col("lemma") == F.col("guess"))
    return out.withColumn("nine_in_ten", out.agg(F.avg(F.col("hit").cast("int")) >= 0.9).scalar())


@query("SELECT s_suppkey, sha256(s_name) AS name_hash, lower(s_name) AS name_lower FROM supplier")
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("s_name")
    return table(spark, sf, "supplier").select(
        "s_suppkey", urls.hash256(name).alias("name_hash"), F.lower(name).alias("name_lower")
    )


# --- scores -----------------------------------------------------------------------------------------------

_SCORES = """SELECT event_id, user_id, event_type, value,
  ((event_id * 37) % 101)::DOUBLE / 100::DOUBLE AS negative, ((event_id * 53) % 97)::DOUBLE / 96::DOUBLE AS positive,
  ((user_id * 31) % 89)::DOUBLE / 88::DOUBLE AS neutral, ((event_id * 11) % 83)::DOUBLE / 82::DOUBLE AS skip,
  value / 500::DOUBLE AS speech FROM events"""
_POLARITY = f"""SELECT *, (exp(positive) - exp(negative)) / (exp(positive) + exp(negative) + exp(neutral) + exp(skip)
  + exp(speech)) AS polarity FROM ({_SCORES})"""


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with five label scores made from their keys."""

    def share(key: str, factor: int, modulus: int):
        return ((F.col(key) * factor) % modulus).cast("double") / float(modulus - 1)

    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value",
        share("event_id", 37, 101).alias("negative"),
        share("event_id", 53, 97).alias("positive"),
        share("user_id", 31, 89).alias("neutral"),
        share("event_id", 11, 83).alias("skip"),
        (F.col("value") / 500.0).alias("speech"),
    )


@query(f"SELECT event_id, {sql.rnd('polarity', 8)} AS sentiment FROM ({_POLARITY})")
def softmax_polarity(spark: SparkSession, sf: str) -> DataFrame:
    return scored_events(spark, sf).select("event_id", rounded(scores.polarity(), 8).alias("sentiment"))


@query(
    "SELECT event_id, label, pos, score FROM (SELECT event_id, label, score, CAST(row_number() OVER (PARTITION BY "
    f"event_id ORDER BY score DESC, label) AS INTEGER) AS pos FROM (UNPIVOT (SELECT event_id, negative, positive, neutral, skip, speech "
    f"FROM ({_SCORES})) ON negative, positive, neutral, skip, speech INTO NAME label VALUE score)) WHERE pos <= 2"
)
def top_k_labels(spark: SparkSession, sf: str) -> DataFrame:
    best = scores.top_labels(reviews.SCORE_LABELS, 2)
    return (
        scored_events(spark, sf)
        .select("event_id", F.posexplode(best).alias("pos", "best"))
        .select("event_id", "best.label", (F.col("pos") + 1).alias("pos"), "best.score")
    )


@query(
    f"WITH d AS (SELECT event_id, polarity + 1 AS x FROM ({_POLARITY})), {sql.boxcox_ctes('d', 'x')}, "
    "y AS (SELECT event_id, (exp(lmbda * (ln(x) - avg(ln(x)) OVER ())) - 1) / lmbda AS y FROM d, lam) "
    f"SELECT event_id, {sql.rnd('(y - avg(y) OVER ()) / stddev_pop(y) OVER ()', 4)} AS sentiment FROM y"
)
def boxcox_scaled(spark: SparkSession, sf: str) -> DataFrame:
    scaled = reviews.with_polarity(scored_events(spark, sf))
    return scaled.select("event_id", rounded(F.col("sentiment"), 4).alias("sentiment"))


@query(
    f"WITH {sql.boxcox_ctes('events', 'value', 'event_type')} SELECT g AS event_type, {sql.rnd('lmbda', 5)} AS lmbda FROM lam"
)
def boxcox_lambdas(spark: SparkSession, sf: str) -> DataFrame:
    fitted = stats.boxcox_lambda(table(spark, sf, "events"), "value", ["event_type"])
    return fitted.select("event_type", rounded(F.col("lmbda"), 5).alias("lmbda"))


@query(
    f"SELECT event_id, {sql.rnd('(value - avg(value) OVER ()) / stddev_pop(value) OVER ()', 6)} AS scaled, "
    f"{sql.rnd('(value - avg(value) OVER (PARTITION BY event_type)) / stddev_pop(value) OVER (PARTITION BY event_type)', 6)}"
    " AS scaled_in_type FROM events"
)
def zscore(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    both = stats.zscore(stats.zscore(events, "value", "scaled"), "value", "scaled_in_type", ["event_type"])
    return both.select(
        "event_id", rounded(F.col("scaled"), 6).alias("scaled"), rounded(F.col("scaled_in_type"), 6).alias("scaled_in_type")
    )


@query(
    "SELECT doc_id, CASE dataset WHEN 'a' THEN quality - toxic END AS sentiment, clean AS review FROM (SELECT l.doc_id, "
    f"'a' AS dataset, quality, toxic, {sql.clean('d.text')} AS clean FROM labels l JOIN documents d USING (doc_id)) "
    "WHERE clean <> ''"
)
def training_texts(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_texts(spark, sf)


def labelled_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned training set: labels as names, mapped to -1, 0, 1."""
    labels = table(spark, sf, "labels").select(
        "doc_id",
        F.element_at(F.array(F.lit("negative"), F.lit("neautral"), F.lit("positive")), F.col("quality") - F.col("toxic") + 2)
        .alias("sentiment"),
    )
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("review"))
    return reviews.training_set(labels.join(docs, "doc_id"), "rureviews").select("doc_id", "sentiment", "review")
