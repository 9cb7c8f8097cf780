"""Rollups, the final table, and jobs over files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuemart.catalog import query, scratch, small_ranges, table
from venuemart.catalog import sqltext as sql
from venuemart.catalog.texts import _POLARITY, rounded, scored_events
from venuemart.functions.urls import cache_key, hash256
from venuemart.plans import final, reviews
from venuemart.sources import files, pages
from venuemart.sources.known import KnownPages

# Text of a file that one task writes.
FILE_BYTES = 32 << 20

_MENTION_ROWS = f"""SELECT user_id AS global_id, 'dish' AS aspect, event_type AS value, event_id % 3 + 1 AS count,
  polarity + 1 AS x FROM ({_POLARITY})"""


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Scored mentions: users as venues, event types as dishes."""
    return scored_events(spark, sf).select(
        F.col("user_id").alias("global_id"),
        F.col("event_id").alias("sentence_id"),
        F.lit("dish").alias("aspect"),
        F.col("event_type").alias("value"),
        (F.col("event_id") % 3 + 1).alias("count"),
        *reviews.SCORE_LABELS,
    )


@query(
    f"WITH d AS ({_MENTION_ROWS}), {sql.boxcox_ctes('d', 'x')}, y AS (SELECT d.*, (exp(lmbda * (ln(x) - avg(ln(x)) OVER ())) - 1) / lmbda AS y FROM d, lam), "
    "z AS (SELECT *, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS s FROM y) "
    f"SELECT global_id, aspect, value, {sql.rnd('avg(s)', 4)} AS sentiment, CAST(sum(count) AS BIGINT) AS count FROM z "
    "GROUP BY global_id, aspect, value"
)
def named_aspect_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.named_aspects(_mentions(spark, sf)).withColumn("sentiment", rounded(F.col("sentiment"), 4))


_MEANS = f"SELECT global_id, aspect, value, avg(x) - 1 AS mean, CAST(sum(count) AS BIGINT) AS count FROM ({_MENTION_ROWS}) GROUP BY global_id, aspect, value"


@query(f"SELECT global_id, aspect, value, {sql.rnd('mean', 6)} AS sentiment, count FROM ({_MEANS})")
def named_aspect_means(spark: SparkSession, sf: str) -> DataFrame:
    """The same rollup of unscaled sentiment."""
    return reviews.named_aspects(_mentions(spark, sf), scaled=None).withColumn("sentiment", rounded(F.col("sentiment"), 6))


@query(
    f"WITH d AS (SELECT *, mean + 1 AS x FROM ({_MEANS})), {sql.boxcox_ctes('d', 'x')}, y AS (SELECT d.*, (exp(lmbda * (ln(x) - avg(ln(x)) OVER ())) - 1) / lmbda AS y FROM d, lam) "
    f"SELECT global_id, aspect, value, {sql.rnd('(y - avg(y) OVER ()) / stddev_pop(y) OVER ()', 4)} AS sentiment, count FROM y"
)
def named_aspect_scaled_after(spark: SparkSession, sf: str) -> DataFrame:
    """The means scaled after the rollup."""
    return reviews.named_aspects(_mentions(spark, sf), scaled="after").withColumn("sentiment", rounded(F.col("sentiment"), 4))


_STARS = "SELECT l_suppkey AS global_id, l_returnflag AS fname, CAST(l_quantity AS INTEGER) AS rating FROM lineitem"


def _stars(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("global_id"), F.col("l_returnflag").alias("fname"), F.col("l_quantity").cast("int").alias("rating")
    )


@query(
    f"SELECT global_id, {sql.rnd('avg(r)', 6)} AS rating FROM (SELECT global_id, fname, avg(rating) AS r FROM ({_STARS}) "
    "GROUP BY global_id, fname) GROUP BY global_id"
)
def two_level_rating(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.venue_ratings(_stars(spark, sf)).withColumn("rating", rounded(F.col("rating"), 6))


@query(
    f"WITH d AS (SELECT global_id, fname, avg(rating) AS r FROM ({_STARS}) GROUP BY global_id, fname), "
    f"{sql.boxcox_ctes('d', 'r', 'fname')}, y AS (SELECT global_id, fname, r, (exp(lmbda * (ln(r) - avg(ln(r)) OVER (PARTITION BY fname))) - 1) / lmbda AS y FROM d "
    "JOIN lam ON fname = g), z AS (SELECT *, (y - avg(y) OVER (PARTITION BY fname)) / stddev_pop(y) OVER (PARTITION BY fname) AS s "
    f"FROM y) SELECT global_id, {sql.rnd('avg(r)', 6)} AS rating, {sql.rnd('avg(s)', 3)} AS rating_boxcox_scaled FROM z GROUP BY global_id"
)
def rating_boxcox(spark: SparkSession, sf: str) -> DataFrame:
    rated = reviews.venue_ratings(_stars(spark, sf), scaled=True)
    return rated.select(
        "global_id", rounded(F.col("rating"), 6).alias("rating"),
        rounded(F.col("rating_boxcox_scaled"), 3).alias("rating_boxcox_scaled"),
    )


@query(
    f"""SELECT s.s_suppkey AS global_id, s.s_name AS Name, concat('nation ', s.s_nationkey) AS Address,
  CAST(s.s_suppkey % 50 AS INTEGER) AS SeatsCount, 'нет' AS SocialPrivileges, s.s_acctbal AS x_coord, s.s_acctbal / 2 AS y_coord,
  concat('u/', o.o_orderkey) AS url, o.o_orderstatus AS cuisine, o.o_orderpriority AS phone, o.o_totalprice AS avg_check,
  'daily' AS opening_hours, {sql.rnd('coalesce(r.rating, 0)', 6)} AS rating FROM supplier s JOIN orders o ON o.o_custkey = s.s_suppkey
  LEFT JOIN (SELECT l_suppkey, avg(l_quantity) AS rating FROM lineitem WHERE l_suppkey % 3 > 0 GROUP BY l_suppkey) r
  ON r.l_suppkey = s.s_suppkey"""
)
def final_table(spark: SparkSession, sf: str) -> DataFrame:
    register = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("global_id"),
        F.col("s_name").alias("Name"),
        F.concat(F.lit("nation "), "s_nationkey").alias("Address"),
        (F.col("s_suppkey") % 50).cast("int").alias("SeatsCount"),
        F.lit("нет").alias("SocialPrivileges"),
        F.col("s_acctbal").alias("x_coord"),
        (F.col("s_acctbal") / 2).alias("y_coord"),
    )
    listing = table(spark, sf, "orders").select(
        F.concat(F.lit("u/"), "o_orderkey").alias("url"),
        F.col("o_orderstatus").alias("cuisine"),
        F.col("o_orderpriority").alias("phone"),
        F.col("o_totalprice").alias("avg_check"),
        F.col("o_custkey").alias("global_id"),
        F.lit("daily").alias("opening_hours"),
    )
    lines = table(spark, sf, "lineitem").where("l_suppkey % 3 > 0")
    ratings = lines.groupBy(F.col("l_suppkey").alias("global_id")).agg(F.avg("l_quantity").alias("rating"))
    return final.final_table(register, listing, ratings).withColumn("rating", rounded(F.col("rating"), 6))


@query(
    "SELECT value, global_id, CAST(mentions AS BIGINT) AS mentions, positive FROM (SELECT event_type AS value, user_id AS global_id, "
    f"sum(event_id % 3 + 1) AS mentions, {sql.rnd('avg(positive)', 6)} AS positive FROM ({_POLARITY}) WHERE event_type = 'click' "
    "GROUP BY ALL) ORDER BY positive DESC, global_id LIMIT 5"
)
def dish_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Venues with the best mean score of one dish."""
    from venuemart.operators.explore import top_k

    clicks = _mentions(spark, sf).where("value = 'click'")
    means = clicks.groupBy("value", "global_id").agg(
        F.sum("count").alias("mentions"), rounded(F.avg("positive"), 6).alias("positive")
    )
    return top_k(means, 5, "positive", ["global_id"])


# --- files ------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus, concat(o_orderpriority, chr(10), '\"a\", b') AS note, "
       "concat('[\"', o_orderstatus, '\",\"x\"]') AS tags FROM orders")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.concat("o_orderpriority", F.lit('\n"a", b')).alias("note"),
        F.array("o_orderstatus", F.lit("x")).alias("tags"),
    )
    files.write_csv(orders, folder)
    read = files.read_csv(spark, folder, orders.schema)
    return read.withColumn("tags", F.to_json("tags"))


@query("SELECT doc_id, quality, toxic FROM labels")
def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "json")
    labels = table(spark, sf, "labels")
    files.write(labels, folder, "json")
    # The JSON-lines files of the sink are one value per line; read as a folder of chunks they need lines.
    return spark.read.schema(labels.schema).json(folder)


@query("SELECT doc_id, quality FROM labels")
def tsv_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Header-less tab-separated splits read back as one table, columns named by position."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    paths = []
    for part in range(3):
        paths.append(scratch(spark, f"tsv{part}"))
        labels.where(F.col("doc_id") % 3 == part).write.option("sep", "\t").csv(paths[-1])
    return files.read_csv(spark, paths, "doc_id long, quality int", sep="\t", header=False, multi_line=False)


@query("SELECT doc_id, quality, CASE WHEN doc_id % 2 = 0 THEN toxic END AS toxic FROM labels")
def csv_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Files with different column orders, one without a column."""
    folder = scratch(spark, "union")
    labels = table(spark, sf, "labels")
    labels.where("doc_id % 2 = 0").select("toxic", "doc_id", "quality").write.mode("append").option("header", True).csv(folder)
    labels.where("doc_id % 2 = 1").select("quality", "doc_id").write.mode("append").option("header", True).csv(folder)
    return files.read_by_name(spark, folder, "doc_id long, quality int, toxic int")


@query(
    "SELECT global_id, round(avg(rating), 8) AS rating FROM (SELECT global_id, src, avg(rating) AS rating FROM (SELECT l_suppkey AS global_id, "
    "l_orderkey % 3 AS src, CAST(l_linenumber AS INTEGER) AS rating FROM lineitem) GROUP BY global_id, src) GROUP BY global_id"
)
def ratings_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Star tables of three sources, in 1, 4 and 16 part files, two formats: each source counts once."""
    from venuemart.plans import jobs

    folder = scratch(spark, "stars")
    stars = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("global_id"), F.lit("food").alias("aspect_stars"), F.lit("u").alias("url"),
        F.col("l_linenumber").cast("int").alias("rating"), (F.col("l_orderkey") % 3).alias("src"),
    )
    for source, parts, kind in ((0, 1, "csv"), (1, 4, "parquet"), (2, 16, "csv")):
        part = stars.where(F.col("src") == source).drop("src").repartition(parts)
        files.write(part, f"{folder}/source{source}.{kind}", kind)
    jobs.collect_aspects(spark, folder, f"{folder}-rating")
    return spark.read.parquet(f"{folder}-rating").select("global_id", rounded(F.col("rating"), 8).alias("rating"))


@query("SELECT c.c_nationkey AS nation, CAST(n AS BIGINT) AS customers, n > 0 AS from_file FROM (SELECT c_nationkey, count(*) AS n "
       "FROM customer GROUP BY c_nationkey) c")
def file_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Rows know the file they came from: one folder per nation is written, and read back with its path."""
    folder = scratch(spark, "by-nation")
    table(spark, sf, "customer").select("c_custkey", "c_nationkey").write.partitionBy("c_nationkey").json(folder)
    rows = spark.read.schema("c_custkey long").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).json(folder)
    rows = files.with_file_name(files.with_file_name(rows, "fname"), "path", full_path=True)
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int")
    named = F.regexp_like("fname", F.lit("^part-.*json$"))
    return rows.groupBy(nation.alias("nation")).agg(
        F.count(F.lit(1)).alias("customers"), F.bool_and(named).alias("from_file")
    )


@query("SELECT url, page_id % 4 > 0 AS ok, CAST(CASE WHEN page_id % 4 > 0 THEN 200 ELSE 404 END AS INTEGER) AS status_code, "
       "sha256(html) AS sha256, CASE WHEN page_id % 4 > 0 THEN page_id END AS data FROM pages")
def page_envelope(spark: SparkSession, sf: str) -> DataFrame:
    saved = table(spark, sf, "pages").select(
        "url", "html", (F.col("page_id") % 4 > 0).alias("ok"),
        F.when(F.col("page_id") % 4 > 0, F.lit(200)).otherwise(F.lit(404)).alias("status_code"), F.col("page_id").alias("data"),
    )
    return pages.envelope(saved, "data").select("url", "ok", "status_code", "sha256", "data")


@query("SELECT page_id, concat('chunk_', sha256(url), '.json') AS key, sha256(html) AS content FROM pages")
def url_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", cache_key(F.col("url")).alias("key"), hash256(F.col("html")).alias("content")
    )


@query("SELECT page_id, url AS link, concat('chunk_', sha256(url), '.json') AS key FROM (SELECT page_id, url FROM pages ORDER BY "
       "page_id LIMIT 200) WHERE page_id % 3 <> 0 OR page_id % 2 = 0")
def frontier(spark: SparkSession, sf: str) -> DataFrame:
    """Every third page is in the cache, half of those failed; the limit is the job's own option."""
    links = table(spark, sf, "pages").select("page_id", F.col("url").alias("link"))
    cache = table(spark, sf, "pages").where("page_id % 3 = 0").select(
        cache_key(F.col("url")).alias("key"), (F.col("page_id") % 2 != 0).alias("ok")
    )
    return pages.frontier(links, cache, limit=200, pos="page_id")


@query("SELECT page_id, url AS link, concat('chunk_', sha256(url), '.json') AS key FROM pages WHERE url NOT IN "
       "(SELECT url FROM pages WHERE page_id % 3 = 0 AND page_id % 2 <> 0 OR page_id % 5 = 0)")
def kept_frontier(spark: SparkSession, sf: str) -> DataFrame:
    """What two runs leave to be fetched: one got every third page, failing on half of them, one every fifth."""
    links = table(spark, sf, "pages").select("page_id", F.col("url").alias("link"))
    entry = [cache_key(F.col("url")).alias("key"), F.lit("2031-02-03 04:05:06").alias("dttm")]
    state = KnownPages(spark, scratch(spark, "known"), buckets=16, capacity=100_000)
    state.remember(table(spark, sf, "pages").where("page_id % 3 = 0").select(*entry, (F.col("page_id") % 2 != 0).alias("ok")))
    state.remember(table(spark, sf, "pages").where("page_id % 5 = 0").select(*entry, F.lit(True).alias("ok")))
    return state.frontier(links, pos="page_id")


@query("SELECT page_id, url AS link, concat('chunk_', sha256(url), '.json') AS key FROM pages WHERE page_id % 3 = 0 AND page_id % 2 <> 0")
def cached_pages(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "pages").select("page_id", F.col("url").alias("link"))
    cache = table(spark, sf, "pages").where("page_id % 3 = 0").select(
        cache_key(F.col("url")).alias("key"), (F.col("page_id") % 2 != 0).alias("ok")
    )
    return pages.cached(links, cache)



# --- chunks and jobs ---------------------------------------------------------------------------------------


def _chunk_files(df: DataFrame, name: str) -> str:
    """The `value` of each row as a `*.json` file of its own partition's part files."""
    folder = scratch(df.sparkSession, name)
    n = df.count()
    numbered = df.withColumn("_n", F.row_number().over(Window.orderBy("value")) - 1)
    numbered.repartitionByRange(n, "_n").select("value").write.option("lineSep", "\n").text(folder)
    # The text sink names its files .txt; a JSON reader of whole files takes them by the folder's glob.
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    for x in store.listStatus(path):
        old = x.getPath()
        if old.getName().endswith(".txt"):
            store.rename(old, df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{folder}/{old.getName()[:-4]}.json"))
    return folder


def _by_nation(spark: SparkSession, sf: str, body) -> DataFrame:
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(F.to_json(body).alias("value")).select("value")


def _concat(spark: SparkSession, chunks: DataFrame, schema: str, is_list: bool) -> DataFrame:
    from venuemart.plans import jobs

    out = scratch(spark, "merged")
    jobs.concat_data(spark, _chunk_files(chunks, "chunks"), out, schema, is_list)
    return spark.read.schema(schema if " " in schema else f"value {schema}").json(out)


@query("SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY c_nationkey")
def concat_objects(spark: SparkSession, sf: str) -> DataFrame:
    body = F.struct(F.first("c_nationkey").alias("nation"), F.count(F.lit(1)).alias("customers"))
    return _concat(spark, _by_nation(spark, sf, body), "nation int, customers long", False)


@query("SELECT c_custkey, c_mktsegment FROM customer")
def concat_lists(spark: SparkSession, sf: str) -> DataFrame:
    body = F.collect_list(F.struct("c_custkey", "c_mktsegment"))
    return _concat(spark, _by_nation(spark, sf, body), "c_custkey long, c_mktsegment string", True)


@query("SELECT c_custkey AS value FROM customer")
def concat_scalars(spark: SparkSession, sf: str) -> DataFrame:
    return _concat(spark, _by_nation(spark, sf, F.collect_list("c_custkey")), "long", True)


@query("SELECT c_custkey FROM customer WHERE false")
def concat_nothing(spark: SparkSession, sf: str) -> DataFrame:
    """A folder without files of the kind asked for."""
    folder = scratch(spark, "empty")
    table(spark, sf, "customer").write.parquet(folder)
    return files.read_json_folder(spark, folder, "c_custkey long")


@query("SELECT CASE toxic WHEN 1 THEN 'negative' ELSE 'positive' END AS sentiment, doc_id::VARCHAR AS review FROM labels")
def tsv_with_header(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("review"), F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("sentiment")
    )
    folder = scratch(spark, "tsv")
    labels.write.option("sep", "\t").option("header", True).csv(folder)
    return files.read_csv(spark, folder, "review string, sentiment string", sep="\t", multi_line=False)


def _n_files(rows: DataFrame, width: Column) -> int:
    """Files that take about FILE_BYTES each, if a row takes `width` bytes."""
    return 1 + int(rows.agg(F.sum(width)).first()[0] or 0) // FILE_BYTES


def _array_files(rows: DataFrame, key: str, value: Column, n: int) -> DataFrame:
    """Lines of n files that each hold one JSON array: the values in the order of `key`, by ranges of it."""
    cuts = rows.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 10_000)).first()[0] if n > 1 else None
    file = F.size(F.filter(F.array(*[F.lit(x) for x in sorted(set(cuts or []))]), lambda cut: cut <= F.col(key)))
    lines = rows.select(F.col(key).alias("at"), value.alias("value"), file.alias("file"), F.lit(False).alias("last"))
    ends = lines.where("value IS NOT NULL").select(F.lit(None).alias("at"), F.lit("]").alias("value"), "file", F.lit(True).alias("last"))
    dealt = lines.union(ends.distinct()).repartitionById(n, "file").sortWithinPartitions("last", F.col("at").asc_nulls_last())
    # A row's number in its file; keys may repeat, so they do not tell which row is the first.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    mark = F.when(F.col("last"), "").when(number == 0, "[").otherwise(",")
    return dealt.select(F.concat(mark, "value").alias("value"))


@query("SELECT doc_id, text, lang, n_chars, len(regexp_extract_all(text, chr(10))) AS breaks FROM documents")
def csv_file_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in one CSV file (large tables: several), line breaks and quotes in the text; read in small ranges."""
    folder = scratch(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", F.concat(F.lit('"'), "text", F.lit('",')).alias("text"), "lang", "n_chars")
    n = _n_files(docs, F.octet_length("text"))
    files.write_csv(docs.repartition(n) if n > 1 else docs.coalesce(1), folder)
    with small_ranges(spark, folder):
        read = files.read_csv(spark, folder, docs.schema).checkpoint()
    text = F.expr("substring(text, 2, length(text) - 3)")
    return read.select("doc_id", text.alias("text"), "lang", "n_chars", F.size(F.regexp_extract_all(text, F.lit("\n"), F.lit(0))).cast("long").alias("breaks"))


@query("SELECT doc_id, text, lang, list_transform(range(0, doc_id % 4), lambda i: concat('],[', i)) AS tags FROM documents")
def json_array_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in one file that holds one JSON array (large tables: several), brackets and commas in its strings;
    read in small ranges."""
    folder = scratch(spark, "json")
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", "lang", F.transform(F.sequence(F.lit(0), F.col("doc_id") % 4), lambda i: F.concat(F.lit("],["), i)).alias("tags")
    )
    docs = docs.withColumn("tags", F.slice("tags", 1, (F.col("doc_id") % 4).cast("int")))
    # One line per element.
    lines = _array_files(docs, "doc_id", F.to_json(F.struct(*docs.columns)), _n_files(docs, F.octet_length("text")))
    lines.write.text(folder)
    with small_ranges(spark, folder):
        return files.read_json_arrays(spark, folder, docs.schema, glob="part-*").checkpoint()


@query("SELECT l_orderkey * 8 + l_linenumber AS value FROM lineitem")
def json_numbers_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A plain array of numbers on one line (large tables: several files of one), read in small ranges."""
    folder = scratch(spark, "json")
    ids = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("v"))
    number = F.col("v").cast("string")
    lines = _array_files(ids, "v", number, _n_files(ids, F.octet_length(number) + 2))
    lines.write.option("lineSep", " ").text(folder)
    with small_ranges(spark, folder):
        return files.read_json_values(spark, folder, "long", True, glob="part-*").checkpoint()
