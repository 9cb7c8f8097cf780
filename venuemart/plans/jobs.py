"""Jobs: read, call, write. One per command; arguments are plain values."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from venuemart import schemas
from venuemart.lexicons import SCORE_LABELS
from venuemart.ml import labels
from venuemart.ml.train import sentiment_pipeline
from venuemart.operators.mentions import find_mentions
from venuemart.plans import final, listing, register, reviews
from venuemart.sources import files, pages
from venuemart.sources.known import KnownPages


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table between two jobs, or CSV with header if the path says so."""
    if path.rstrip("/").endswith(".csv"):
        return files.read_csv(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def _any_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as it is: Parquet, or CSV with header whose columns stay text."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    files.write(df, path, "csv" if path.rstrip("/").endswith(".csv") else "parquet")


def concat_data(
    spark: SparkSession, input: str, output: str, schema: str, is_list: bool = False, format: str = "json"
) -> None:
    """Merge a folder of JSON files.

    `schema` is a row schema (files of one object or of a list of objects, `is_list` or not), or the type of a
    plain value such as `int` or `array<struct<a: int>>`; with `is_list` files hold lists of it.
    """
    if isinstance(_parse_datatype_string(schema), T.StructType) and not schema.lstrip().lower().startswith("struct<"):
        data = files.read_json_arrays(spark, input, schema)
    else:
        data = files.read_json_values(spark, input, schema, is_list)
    files.write(data, output, format)


def process_register(spark: SparkSession, input: str, output: str, schema: str = schemas.REGISTER_RAW) -> None:
    """Every field of `Cells` that the schema declares becomes a column."""
    write_table(register.flatten_register(files.read_json_arrays(spark, input, schema)), output)


def register_mart(spark: SparkSession, input: str, output: str, strict_reference: bool = False) -> None:
    write_table(register.register_mart(read_table(spark, input, schemas.REGISTER), strict_reference), output)


def collect_register(spark: SparkSession, input: str, output: str) -> None:
    """Raw export to mart in one go, nothing stored in between."""
    raw = files.read_json_arrays(spark, input, schemas.REGISTER_RAW)
    write_table(register.register_mart(register.flatten_register(raw)), output)


def process_listing(spark: SparkSession, input: str, output: str, site: str) -> None:
    envelopes = files.with_file_name(files.read_json_folder(spark, input, schemas.LISTING_ENVELOPE))
    write_table(listing.listing_table(envelopes, site), output)


def process_details(spark: SparkSession, input: str, output: str, strict_reference: bool = False) -> None:
    envelopes = files.with_file_name(files.read_json_folder(spark, input, schemas.DETAIL_ENVELOPE))
    write_table(listing.details_table(envelopes, strict_reference), output)


def listing_mart(
    spark: SparkSession,
    input: str,
    input_details: str,
    input_register: str,
    output: str,
    output_aspect: str,
    output_review: str,
    source: str,
    dist_threshold: float = 300.0,
) -> None:
    """`input_register` needs global_id, x_coord, y_coord and Name_norm (the register mart)."""
    names = "global_id long, x_coord double, y_coord double, Name_norm string"
    if input_register.rstrip("/").endswith(".csv"):
        register_rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(input_register)
        register_rows = register_rows.selectExpr(
            "cast(global_id as long)", "cast(x_coord as double)", "cast(y_coord as double)", "Name_norm"
        )
    else:
        register_rows = spark.read.schema(names).parquet(input_register)
    main, aspects, sentences, matched = listing.listing_mart(
        read_table(spark, input, schemas.LISTING),
        read_table(spark, input_details, schemas.DETAILS),
        register_rows,
        source,
        dist_threshold,
    )
    for table, path in ((main, output), (aspects, output_aspect), (sentences, output_review)):
        write_table(table, path)
    matched.unpersist()


def create_text_features(
    spark: SparkSession, input: str, output: str, col_text: str = "review", lemmas: str | None = None,
    model: str | None = None, label_model: str | None = None,
) -> None:
    """`lemmas`: a table (token, lemma). Label scores come from a saved classifier (`model`) or from what
    `train_label_model` saved (`label_model`)."""
    from venuemart.ml.features import model_scorer

    if model and label_model:
        raise ValueError("name one scorer, model or label_model")
    table = read_table(spark, lemmas, "token string, lemma string") if lemmas else None
    scorer = model_scorer(PipelineModel.load(model)) if model else None
    if label_model:
        scorer = labels.scorer(labels.LabelModel.load(spark, label_model))
    data = read_table(spark, input, schemas.SENTENCE)
    write_table(reviews.text_features(data, col_text, lemmas=table, scorer=scorer), output)


def create_aspects(
    spark: SparkSession,
    input: str,
    output: str,
    col_text: str = "review_norm",
    col_sentence: str = "sentence_id",
    col_id: str = "global_id",
    global_features: list[str] = reviews.MENTION_FEATURES,
    schema: str = schemas.SENTENCE_SCORED,
) -> None:
    data = read_table(spark, input, schema)
    write_table(find_mentions(data, col_text, [col_id, col_sentence], list(global_features)), output)


def collect_named_aspects(spark: SparkSession, input: str, output: str, scaled: str | None = "before") -> None:
    """`input`: a folder of mention tables, CSV or Parquet, one per source, or one such table."""
    write_table(reviews.named_aspects(files.read_by_name(spark, input, schemas.MENTION_SCORED), scaled), output)


def collect_aspects(spark: SparkSession, input: str, output: str, scaled: bool = False) -> None:
    """`input`: a folder of star tables, CSV or Parquet, one per source; `fname` is the table's path."""
    stars = files.read_by_name(spark, input, schemas.STAR_ASPECT, source="fname")
    write_table(reviews.venue_ratings(stars, scaled), output)


def create_final_dataset(
    spark: SparkSession, input: str, input_listing: str, input_rating: str, output: str
) -> None:
    """Register mart, main listing table and venue ratings (Parquet)."""
    rows = final.final_table(
        _any_table(spark, input), _any_table(spark, input_listing), read_table(spark, input_rating, schemas.RATING)
    )
    write_table(rows, output)


def transform_sentiments(spark: SparkSession, input: str, dataset: str, output: str) -> None:
    write_table(reviews.training_set(read_table(spark, input, schemas.SENTIMENT_RAW), dataset), output)


def train_sentiment_model(spark: SparkSession, input: str, output: str, **settings) -> PipelineModel:
    data = read_table(spark, input, schemas.SENTIMENT_TRAIN)
    model = sentiment_pipeline(n_rows=data.count(), **settings).fit(data.withColumn("label", F.col("sentiment") + 1.0))
    model.write().overwrite().save(output)
    return model


def train_label_model(spark: SparkSession, input: str, output: str, names: list[str] = SCORE_LABELS, **settings) -> labels.LabelModel:
    """Learn the labels `names` from a table (review, label), as a scorer for `create_text_features`."""
    model = labels.fit(read_table(spark, input, "review string, label string"), "review", "label", names, **settings)
    model.save(spark, output)
    return model


def load_sentiment(spark: SparkSession, reviews_tsv: str, splits: list[str], output_reviews: str, output_splits: str):
    """Tab-separated labelled texts with a header, and header-less splits of another set, to tables."""
    write_table(files.read_csv(spark, reviews_tsv, schemas.SENTIMENT_RAW, sep="\t", multi_line=False), output_reviews)
    write_table(files.read_csv(spark, splits, schemas.SENTIMENT_RAW, sep="\t", header=False, multi_line=False), output_splits)


def page_frontier(
    spark: SparkSession, input: str, cache: str, output: str, limit: int | None = None, known: str | None = None
) -> None:
    """Links of the listing table that are not in the page cache (key, ok, dttm) yet.

    With `known`, a folder that keeps the keys between runs, `cache` needs to hold the entries since the last run only.
    """
    links = read_table(spark, input, schemas.LISTING).select(
        "link", F.struct("fname", "link").alias("pos")
    )
    entries = spark.read.parquet(cache)
    if known:
        state = KnownPages(spark, known)
        state.remember(entries)
        left = state.frontier(links, limit)
    else:
        left = pages.frontier(links, entries, limit)
    write_table(left.select("link", "key"), output)
