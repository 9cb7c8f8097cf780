"""Profiling, filter, window and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.catalog import query, table
from venuemart.catalog import sqltext as sql
from venuemart.catalog.texts import rounded
from venuemart.functions import text
from venuemart.operators import explore, ids, sketches, whole


@query(
    "SELECT doc_id, lang, source, text FROM (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n "
    "FROM documents) WHERE n = 1"
)
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text", F.sha2("text", 256).alias("h"))
    return ids.first_per_key(docs, ["h"], [F.col("doc_id")]).drop("h")


@query(
    "SELECT event_id, CASE event_type WHEN 'error' THEN -1 WHEN 'click' THEN 1 WHEN 'view' THEN 0 END AS mapped, "
    "CASE event_type WHEN 'error' THEN 'failure' ELSE event_type END AS renamed FROM events"
)
def value_map(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        text.map_values_of(kind, {"error": -1, "click": 1, "view": 0}).alias("mapped"),
        text.map_values_of(kind, {"error": "failure"}, kind).alias("renamed"),
    )


@query(
    "SELECT event_id, coalesce(CASE WHEN user_id % 3 > 0 THEN value END, 0) AS value, "
    "coalesce(CASE WHEN user_id % 2 > 0 THEN event_type END, '') AS event_type FROM events"
)
def fill_default(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("user_id") % 3 > 0, F.col("value")).alias("value"),
        F.when(F.col("user_id") % 2 > 0, F.col("event_type")).alias("event_type"),
    )
    return rows.na.fill({"value": 0.0, "event_type": ""})


@query("SELECT p_partkey, p_name, p_size FROM part WHERE contains(lower(p_name), 'ring') AND p_size IN (1, 5, 11, 20) OR p_brand = 'Brand#7'")
def row_filters(spark: SparkSession, sf: str) -> DataFrame:
    name = F.lower("p_name")
    wanted = (F.contains(name, F.lit("ring")) & F.col("p_size").isin(1, 5, 11, 20)) | (F.col("p_brand") == "Brand#7")
    return table(spark, sf, "part").where(wanted).select("p_partkey", "p_name", "p_size")


_PIECE = "CASE doc_id % 4 WHEN 0 THEN ' ' || chr(160) || chr(10) WHEN 1 THEN '' WHEN 2 THEN NULL ELSE source END"


@query(f"SELECT doc_id, piece FROM (SELECT doc_id, {_PIECE} AS piece FROM documents) WHERE regexp_matches(piece, '{sql.NOT_BLANK}')")
def not_blank(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("doc_id") % 4
    piece = F.when(key == 0, F.lit("  \n")).when(key == 1, F.lit("")).when(key == 3, F.col("source"))
    rows = table(spark, sf, "documents").select("doc_id", piece.alias("piece"))
    return rows.where(text.not_blank(F.col("piece")))


@query("SELECT p_partkey AS global_id, p_name AS part_Name, p_brand AS part_Brand, 'shop' AS source FROM part WHERE p_retailprice <= 1000")
def select_rename(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").where(F.col("p_retailprice") <= 1000)
    named = rows.withColumnsRenamed({"p_partkey": "global_id", "p_name": "Name", "p_brand": "Brand"})
    prefixed = named.withColumnsRenamed({c: f"part_{c}" for c in ("Name", "Brand")})
    return prefixed.select("global_id", "part_Name", "part_Brand", F.lit("shop").alias("source"))


@query(
    f"SELECT l_returnflag, l_linestatus, {sql.rnd('avg(l_quantity)', 6)} AS mean_qty, {sql.rnd('avg(l_discount)', 6)} AS mean_discount, "
    f"{sql.rnd('sum(l_extendedprice)', 2)} AS sum_price FROM lineitem GROUP BY ALL"
)
def multi_mean(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        rounded(F.avg("l_quantity"), 6).alias("mean_qty"),
        rounded(F.avg("l_discount"), 6).alias("mean_discount"),
        rounded(F.sum("l_extendedprice"), 2).alias("sum_price"),
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey LIMIT 10")
def sorted_head(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.orderBy("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey").limit(10)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem "
    "ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC LIMIT 15"
)
def sorted_tail(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.orderBy(*[F.desc(c) for c in ("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")]).limit(15)


# --- profiles ---------------------------------------------------------------------------------------------


@query(
    "SELECT kind, count(*) AS count FROM (SELECT CASE WHEN event_id % 11 > 0 THEN event_type END AS kind FROM events) GROUP BY kind"
)
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(F.when(F.col("event_id") % 11 > 0, F.col("event_type")).alias("kind"))
    return explore.value_counts(rows, "kind", dropna=False)


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count DESC, user_id LIMIT 10")
def value_counts_head(spark: SparkSession, sf: str) -> DataFrame:
    return explore.value_counts(table(spark, sf, "events"), "user_id", n=10)


@query("SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY count, user_id DESC LIMIT 15")
def value_counts_tail(spark: SparkSession, sf: str) -> DataFrame:
    return explore.value_counts(table(spark, sf, "events"), "user_id", n=15, tail=True)


@query(
    "SELECT 'o_orderstatus' AS column, count(*) - count(s) AS nulls, count(s) AS values FROM (SELECT CASE WHEN o_orderkey % 4 > 0 "
    "THEN o_orderstatus END AS s FROM orders) UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), count(o_totalprice) "
    "FROM orders"
)
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("o_orderstatus")
    return explore.null_profile(table(spark, sf, "orders").select(status, "o_totalprice"))


@query(
    "SELECT f AS found, t AS total, f::DOUBLE / t AS share FROM (SELECT count(DISTINCT doc_id) AS f FROM labels), "
    "(SELECT count(DISTINCT doc_id) AS t FROM documents)"
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return explore.coverage(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id")


@query(
    "WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS n FROM orders) SELECT bin, "
    f"{sql.rnd('lo + bin * ((hi - lo) / 20)', 6)} AS low, {sql.rnd('lo + (bin + 1) * ((hi - lo) / 20)', 6)} AS high, count(*) AS count, "
    "round(count(*)::DOUBLE / (n * ((hi - lo) / 20)), 12) AS density FROM (SELECT CAST(least(floor((o_totalprice - lo) / "
    "((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo, hi, n FROM orders, b) GROUP BY bin, lo, hi, n"
)
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    bins = explore.histogram(table(spark, sf, "orders"), "o_totalprice", 20, density=True)
    return bins.select(
        "bin", rounded(F.col("low"), 6).alias("low"), rounded(F.col("high"), 6).alias("high"), "count",
        F.round("density", 12).alias("density"),
    )


@query("SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return explore.top_k(parts, 10, "p_retailprice", ["p_partkey"])


@query("SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 5")
def bottom_k(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return explore.top_k(parts, 5, "p_retailprice", ["p_partkey"], largest=False)


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name = 'red widget' ORDER BY p_retailprice DESC, p_partkey LIMIT 5")
def top_k_filtered(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").where("p_name = 'red widget'").select("p_partkey", "p_name", "p_retailprice")
    return explore.top_k(parts, 5, "p_retailprice", ["p_partkey"])


@query("SELECT doc_id, lang FROM documents ORDER BY md5(concat('17:', doc_id)), doc_id LIMIT 20")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return ids.seeded_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 20, seed=17)


@query(
    "SELECT conv_id, string_agg(text, '.' ORDER BY turn) AS text FROM conversations GROUP BY conv_id"
)
def reassemble_text(spark: SparkSession, sf: str) -> DataFrame:
    return explore.reassemble(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@query(
    "SELECT doc_id, CAST(pos // 3 AS BIGINT) AS part, string_agg(s, '.' ORDER BY pos) AS text FROM (SELECT doc_id, unnest(p) AS s, "
    "generate_subscripts(p, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, '.') AS p FROM documents)) GROUP BY doc_id, pos // 3"
)
def reassemble_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The sentences of a document put together again, three at a time."""
    pieces = F.posexplode(F.split("text", "[.]")).alias("pos", "text")
    return explore.reassemble(table(spark, sf, "documents").select("doc_id", pieces), "doc_id", "pos", "text", chunk=3)


@query("SELECT doc_id, lang, NULL::INTEGER AS quality FROM documents UNION ALL SELECT doc_id, NULL, quality FROM labels")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("lang", "doc_id")
    return docs.unionByName(table(spark, sf, "labels").select("quality", "doc_id"), allowMissingColumns=True)


@query("SELECT l.doc_id, d.lang, d.n_chars, d.source, d.text, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id)")
def column_difference_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return explore.join_missing_columns(docs, table(spark, sf, "labels"), ["doc_id"])



@query("SELECT event_id, 'k' AS aspect, CAST(json_extract(props, '$.k') AS INTEGER) AS rating FROM events WHERE event_id % 3 > 0 "
       "UNION ALL SELECT event_id, 'Еда', CAST(user_id % 6 AS INTEGER) FROM events WHERE event_id % 3 > 0")
def json_map_explode(spark: SparkSession, sf: str) -> DataFrame:
    return _star_maps(spark, sf).select("event_id", F.explode("stars").alias("aspect", "rating"))


def _star_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their JSON map, an extra key added; empty or missing for every third event."""
    events = table(spark, sf, "events")
    props = F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(',"Еда": '), F.col("user_id") % 6, F.lit("}"))
    text_map = F.when(F.col("event_id") % 3 > 0, props).when(F.col("event_id") % 2 == 0, F.lit("{}"))
    return events.select("event_id", F.from_json(text_map, "map<string,int>").alias("stars"))


@query("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, "
       "CASE WHEN event_id % 3 > 0 THEN CAST(user_id % 6 AS INTEGER) END AS \"Еда\" FROM events")
def json_map_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return explore.map_columns(_star_maps(spark, sf), "stars", ["k", "Еда"]).drop("stars")


@query("SELECT event_id, to_json({'k': CAST(json_extract(props, '$.k') AS INTEGER)})::VARCHAR AS stars FROM events")
def json_text_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    stars = F.from_json("props", "map<string,int>")
    return table(spark, sf, "events").select("event_id", F.to_json(stars).alias("stars"))


_PART = 4096


@query(
    "WITH r AS (SELECT role, text, conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY role ORDER BY conv_id, turn "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM conversations WHERE text IS NOT NULL) "
    f"SELECT role, off // {_PART} AS part, min(off) AS start, string_agg(text, '.' ORDER BY off) AS text FROM r GROUP BY ALL"
)
def whole_texts(spark: SparkSession, sf: str) -> DataFrame:
    """All that each role says, in order; a role is a third of the table, so its text comes in parts."""
    place = F.struct("conv_id", "turn").alias("place")
    rows = table(spark, sf, "conversations").select("role", place, "text")
    return whole.text_parts(rows, "role", "place", "text", _PART)


@query("SELECT l_returnflag, l_quantity, count(*) AS count FROM lineitem GROUP BY ALL")
def frequent_values(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches per year put together; with fewer values than are tracked their counts are exact."""
    rows = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    per_year = sketches.value_sketches(rows, "l_quantity", ["l_returnflag", "year"], tracked=100)
    return sketches.frequent_values(sketches.merged(per_year, ["l_returnflag"], tracked=100), "l_quantity", 60).drop("rows")


@query(
    "WITH v AS (SELECT c_nationkey, list_sort(list(c_acctbal::DOUBLE)) AS v FROM customer GROUP BY 1), b AS (SELECT unnest(range(4)) AS bin) "
    "SELECT c_nationkey, bin::INT AS bin, v[greatest(1, ceil(len(v) * bin / 4)::INT)] AS low, v[ceil(len(v) * (bin + 1) / 4)::INT] AS high FROM v, b"
)
def equal_share_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Quarters of the balances of each nation's customers; a sketch is exact while it holds all values."""
    held = sketches.quantile_sketches(table(spark, sf, "customer"), "c_acctbal", ["c_nationkey"], size=8000)
    return sketches.equal_share_bins(held, 4)
