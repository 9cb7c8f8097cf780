"""Feature, training and evaluation queries over the labelled texts."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.catalog import query, scratch, spread, table
from venuemart.catalog import sqltext as sql
from venuemart.catalog.texts import LEMMAS, labelled_texts, rounded
from venuemart.lexicons import SCORE_LABELS
from venuemart.ml import boosting, evaluate, features, labels, multinomial, train
from venuemart.operators import ids
from venuemart.plans import reviews
from venuemart.session import stored

# Components of the classifier's text features.
COMPONENTS = 300


@query(
    r"""WITH c AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text),
  '[\p{L}\p{N}_]{2,}')) AS term FROM documents) GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 5 AND count(*) <= 0.3::DOUBLE * (SELECT n FROM n)),
w AS (SELECT doc_id, term, tf, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS w FROM c JOIN df USING (term), n)
SELECT doc_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 8) AS weight FROM w"""
)
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # A document's terms stay in its task: a table of one or few files is dealt out first.
    few = docs.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    weights = features.tfidf_weights(spread(docs) if few else docs, "doc_id", "text")
    return weights.withColumn("weight", F.round("weight", 8))


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, int]:
    # The split reads the keys three times: texts are cleaned once and stored.
    rows = stored(labelled_texts(spark, sf), "labelled").withColumn("label", F.col("sentiment") + 1.0)
    parts = ids.train_test_split(rows, "doc_id", 0.3, 17, ["sentiment"]).cache()
    training = parts.where("part = 'train'").drop("part")
    return training, parts.where("part = 'test'").drop("part"), training.count()


@query(
    "SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(concat('17:', doc_id)), doc_id) <= "
    "count(*) OVER (PARTITION BY quality) - ceil(count(*) OVER (PARTITION BY quality) * 0.3::DOUBLE) THEN 'train' ELSE 'test' END AS part "
    "FROM labels"
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return ids.train_test_split(labels, "doc_id", 0.3, 17, ["quality"])


@query(
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(concat('17:', doc_id)), doc_id) <= count(*) OVER () - "
    "ceil(count(*) OVER () * 0.3::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM labels"
)
def shuffled_split(spark: SparkSession, sf: str) -> DataFrame:
    return ids.train_test_split(table(spark, sf, "labels").select("doc_id"), "doc_id", 0.3, 17)


_PAIRS = "(SELECT quality - toxic AS label, (doc_id * 7) % 3 - 1 AS prediction FROM labels)"


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        (F.col("quality") - F.col("toxic")).cast("long").alias("label"), ((F.col("doc_id") * 7) % 3 - 1).alias("prediction")
    )


_REPORT = f"""SELECT class, hits::DOUBLE / greatest(predicted, 1) AS precision, hits::DOUBLE / greatest(support, 1) AS recall,
  2.0::DOUBLE * hits / (support + predicted) AS f1, support FROM (SELECT class, count(*) FILTER (label = class AND prediction = class)
  AS hits, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS predicted
  FROM {_PAIRS}, (VALUES (-1), (0), (1)) v(class) GROUP BY class)"""


@query(
    f"SELECT CAST(class AS BIGINT) AS class, {sql.rnd('precision', 8)} AS precision, {sql.rnd('recall', 8)} AS recall, "
    f"{sql.rnd('f1', 8)} AS f1, support FROM ({_REPORT})"
)
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    report = evaluate.classification_report(_predictions(spark, sf))
    return report.select(
        "class", *[rounded(F.col(c), 8).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query(
    f"SELECT 'seven' AS model, {sql.rnd('avg(f1)', 8)} AS macro_f1, {sql.rnd('sum(recall * support) / sum(support)', 8)} AS accuracy "
    f"FROM ({_REPORT})"
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    scores = evaluate.compare({"seven": _predictions(spark, sf)})
    return scores.select("model", rounded(F.col("macro_f1"), 8).alias("macro_f1"), rounded(F.col("accuracy"), 8).alias("accuracy"))


_TEST_PART = (
    f"SELECT doc_id, quality - toxic AS sentiment FROM (SELECT l.*, {sql.clean('d.text')} AS clean, row_number() OVER w AS r, count(*) OVER "
    "(PARTITION BY quality - toxic) AS n FROM labels l JOIN documents d USING (doc_id) WHERE "
    f"{sql.clean('d.text')} <> '' WINDOW w AS (PARTITION BY quality - toxic ORDER BY md5(concat('17:', doc_id)), doc_id)) "
    "WHERE r > n - ceil(n * 0.3::DOUBLE)"
)


@query(f"SELECT doc_id, sentiment, true AS sums_to_one, true AS likeliest, true AS known_label FROM ({_TEST_PART})")
def train_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on the training part; what SQL can say of the scores and predictions of the test part."""
    training, test, n = _split(spark, sf)
    model = train.sentiment_pipeline(n, n_components=COMPONENTS).fit(training)
    return _checked(features.label_scores(model, test, "review")).drop("negative", "neutral", "positive", "predicted")


def _checked(scored: DataFrame) -> DataFrame:
    labels = F.array("negative", "neutral", "positive")
    return scored.select(
        "doc_id", "sentiment", "negative", "neutral", "positive", "predicted",
        (F.abs(F.aggregate(labels, F.lit(0.0), lambda a, v: a + v) - 1) < 1e-9).alias("sums_to_one"),
        (F.get(labels, F.col("predicted") + 1) == F.array_max(labels)).alias("likeliest"),
        F.col("predicted").isin(-1, 0, 1).alias("known_label"),
    )


@query(f"SELECT doc_id, true AS same FROM ({_TEST_PART})")
def saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model file read again scores and predicts as the model did."""
    training, test, n = _split(spark, sf)
    model = train.sentiment_pipeline(n, n_components=20).fit(training)
    path = scratch(spark, "model")
    model.write().overwrite().save(path)
    columns = ["negative", "neutral", "positive", "predicted"]
    first, again = (features.label_scores(m, test, "review") for m in (model, PipelineModel.load(path)))
    again = again.select("doc_id", F.struct(*columns).alias("again"))
    return first.join(again, "doc_id").select("doc_id", (F.struct(*columns) == F.col("again")).alias("same"))


@query(
    f"SELECT doc_id, {sql.clean('text')} AS review_standard, array_to_string(list_transform(string_split({sql.clean('text')}, ' '), lambda t: CASE t "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEMMAS)
    + " ELSE t END), ' ') AS review_norm, " + ", ".join(f"0.0::DOUBLE AS {c}" for c in reviews.SCORE_LABELS) + " FROM documents"
)
def text_features_plain(spark: SparkSession, sf: str) -> DataFrame:
    """Clean text, lemmas, and zeros for labels that no scorer gives."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("review"))
    lemmas = spark.createDataFrame(LEMMAS, "token string, lemma string")
    return reviews.text_features(docs, "review", lemmas).drop("review")


@query(
    "WITH m AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM (SELECT l_quantity::DOUBLE AS a, l_extendedprice::DOUBLE / 1000 AS b "
    "FROM lineitem)), e AS (SELECT (aa + bb) / 2 AS m, sqrt(((aa - bb) / 2) ** 2 + ab ** 2) AS r, aa, ab FROM m), v AS (SELECT 1 AS i, sqrt(m + r) AS s FROM e "
    "UNION ALL SELECT 2, sqrt(m - r) FROM e) SELECT i, round(s, 6) AS singular_value, 1.0::DOUBLE AS length, 0.0::DOUBLE AS inner_product FROM v"
)
def svd_gram(spark: SparkSession, sf: str) -> DataFrame:
    """Singular values and right vectors of a table of two columns, against the closed form."""
    columns = [F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double") / 1000]
    rows = table(spark, sf, "lineitem").select(array_to_vector(F.array(*columns)).alias("tfidf"))
    model = features.TruncatedSVD(k=2).fit(rows)
    right = model.pc.toArray()
    inner = float(abs(right[:, 0] @ right[:, 1]))
    out = model.transform(rows).select(vector_to_array("components").alias("c"))
    sums = [F.sqrt(F.sum(F.col("c")[i] * F.col("c")[i])) for i in range(2)]
    each = [
        F.struct(F.lit(i + 1).alias("i"), F.round(s, 6).alias("singular_value"), F.lit(round(float(right[:, i] @ right[:, i]), 9)).alias("length"),
                 F.lit(round(inner, 9)).alias("inner_product"))
        for i, s in enumerate(sums)
    ]
    return out.agg(F.array(*each).alias("e")).select(F.inline("e"))


@query()
def text_features(spark: SparkSession, sf: str) -> DataFrame:
    """Clean text, lemmas and the five label scores, by a model fitted on the labelled texts."""
    training, _, n = _split(spark, sf)
    model = train.sentiment_pipeline(n, n_components=COMPONENTS).fit(training)
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("review"))
    lemmas = spark.createDataFrame(LEMMAS, "token string, lemma string")
    return reviews.text_features(docs, "review", lemmas, scorer=features.model_scorer(model)).drop("review")


@query()
def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """Results table of a cross-validated search: the scores of all component counts and penalties."""
    training, _, n = _split(spark, sf)
    _, results = train.grid_search(training, "doc_id", n, n_components=[100, 200, 300], cs=[0.1, 1.0, 10.0], folds=4)
    return results.select("n_components", "c", "mean_score", "std_score")


_FOLDS = 3


@query(
    f"WITH r AS (SELECT l_orderkey % {_FOLDS} AS own, (l_quantity > 25)::INT AS x, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS class FROM lineitem) "
    f"SELECT fold, x, class, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY fold, x), 6) AS probability "
    f"FROM r JOIN (SELECT unnest(range({_FOLDS})) AS fold) ON fold <> own GROUP BY fold, x, class"
)
def penalty_free_folds(spark: SparkSession, sf: str) -> DataFrame:
    """One regression per left-out fold, fitted together; with one yes/no feature its probabilities are shares."""
    x = (F.col("l_quantity") > 25).cast("int")
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    fold = F.explode(F.array_except(F.sequence(F.lit(0), F.lit(_FOLDS - 1)), F.array((F.col("l_orderkey") % _FOLDS).cast("int"))))
    rows = table(spark, sf, "lineitem").select(fold.alias("set"), F.lit(False).alias("held"), x.alias("at"), F.array(x.cast("double")).alias("x"), y.alias("y"))
    sets = multinomial.Sets(rows.drop("at"))
    fits, _ = sets.fit([multinomial.Candidate(f, 1, 0.0) for f in range(_FOLDS)], tol=1e-10)
    centres = {r.set: (r.m, r.s) for r in rows.groupBy("set").agg(F.avg("at").alias("m"), F.stddev("at").alias("s")).collect()}
    out = []
    for f, got in enumerate(fits):
        for at in (0, 1):
            scores = (at - centres[f][0]) / centres[f][1] * got.coefficients[0] + got.intercepts
            shares = np.exp(scores) / np.exp(scores).sum()
            out += [(f, at, k, round(float(v), 6)) for k, v in enumerate(shares)]
    return spark.createDataFrame(out, "fold long, x int, class int, probability double")


@query()
def boosted(spark: SparkSession, sf: str) -> DataFrame:
    """Class report of 200 rounds of boosted trees on 200 components, for the test part."""
    training, test, _ = _split(spark, sf)
    model = train.boosted_pipeline(n_estimators=200, n_components=200).fit(training)
    return evaluate.classification_report(model.transform(test))


_EDGES = {"l_quantity": [5.0 * k for k in range(1, 10)], "l_discount": [k / 100 + 0.005 for k in range(9)]}


@query(
    "WITH r AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, l_quantity::DOUBLE AS l_quantity, l_discount::DOUBLE AS l_discount FROM lineitem), "
    "p AS (SELECT y AS class, count(*)::DOUBLE / (SELECT count(*) FROM r) AS p FROM r GROUP BY y), "
    "e AS (" + " UNION ALL ".join(f"SELECT {k} AS feature, {c} AS x, y, unnest({v}) AS edge FROM r" for k, (c, v) in enumerate(_EDGES.items())) + "), "
    "s AS (SELECT feature, class, edge, sum(p - (y = class)::INT) FILTER (x <= edge) AS lg, sum(p * (1 - p)) FILTER (x <= edge) AS lh, "
    "sum(p - (y = class)::INT) FILTER (x > edge) AS rg, sum(p * (1 - p)) FILTER (x > edge) AS rh FROM e, p GROUP BY ALL), "
    "g AS (SELECT *, lg * lg / (lh + 1) + rg * rg / (rh + 1) - (lg + rg) ** 2 / (lh + rh + 1) AS gain FROM s) "
    "SELECT class, feature, edge::DOUBLE AS edge, round(-0.1 * lg / (lh + 1), 6) AS lower, round(-0.1 * rg / (rh + 1), 6) AS upper FROM g "
    "QUALIFY row_number() OVER (PARTITION BY class ORDER BY gain DESC, feature, edge) = 1"
)
def boosted_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """The first round of boosting with one test per class: where it splits the rows, and by how much."""
    rows = table(spark, sf, "lineitem").select(
        F.array(*[F.col(c).cast("double") for c in _EDGES]).alias("x"), F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("y")
    )
    model = boosting.fit(rows, "x", "y", rounds=1, depth=1, edges=np.array(list(_EDGES.values())))
    found = [(c, f[1], model["edges"][f[1]][b[1]], round(leaf[0], 6), round(leaf[1], 6)) for c, (f, b, leaf) in enumerate(model["trees"][0])]
    return spark.createDataFrame(found, "class int, feature int, edge double, lower double, upper double")


@query(
    r"SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(1 + list_sum([1 + length(x) + length(x) - 1 + greatest(length(x) - 2, 0) FOR x IN w]) "
    r"AS BIGINT) AS n_features FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents) WHERE len(w) > 0 "
    r"UNION ALL SELECT doc_id, 0, 1 FROM documents WHERE len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) = 0"
)
def label_features(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document, and its words and character n-grams with repeats."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).cast("long").alias("n_words")
    found = labels.featured(docs.select("doc_id", words, "text"), "text")
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_words", n.alias("n_features"))


@query()
def five_label_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all five labels for the texts left out of training: documents by their labels, and what is said in
    conversations."""
    kinds = F.array(*[F.lit(x) for x in ("skip", "negative", "positive", "neutral")])
    named = table(spark, sf, "labels").select("doc_id", F.get(kinds, 2 * F.col("quality") + F.col("toxic")).alias("label"))
    docs = table(spark, sf, "documents").join(named, "doc_id").select(F.concat(F.lit("document "), "doc_id").alias("id"), "label", "text")
    said = table(spark, sf, "conversations").select(F.concat_ws(" ", F.lit("turn"), "conv_id", "turn").alias("id"), F.lit("speech").alias("label"), "text")
    rows = docs.union(said).withColumn("fold", ids.seeded_fold(F.col("id"), 4, 17))
    model = labels.fit(rows.where("fold > 0"), "text", "label", SCORE_LABELS)
    return labels.scorer(model)(rows.where("fold = 0"), "text").select("id", "label", *SCORE_LABELS)
