"""Register, address, name and matching queries: suppliers are the register, customers the listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart import schemas
from venuemart.catalog import query, table
from venuemart.catalog import sqltext as sql
from venuemart.catalog.texts import rounded
from venuemart.functions import text
from venuemart.functions.address import with_address_parts
from venuemart.operators import match, skew
from venuemart.plans import listing, register

RADIUS = 300.0


def place(key: str, factor: int, modulus: int, start: float) -> Column:
    return F.lit(start) + ((F.col(key) * factor) % modulus).cast("double") / 10000.0


def lon(key: str) -> Column:
    return place(key, 7919, 6007, 37.3)


def lat(key: str) -> Column:
    return place(key, 104729, 4507, 55.5)


# Names and addresses are made from keys, alike in both languages.
_NAME = """concat(CASE s_suppkey % 3 WHEN 0 THEN 'Кафе ' WHEN 1 THEN 'Ресторан ' ELSE '' END,
  CASE WHEN s_suppkey % 2 = 0 THEN '«Зал ' ELSE 'Зал ' END, s_suppkey % 7, CASE WHEN s_suppkey % 2 = 0 THEN '»' ELSE '' END)"""
_TITLE = "concat('ЗАЛ ', c_custkey % 10, CASE WHEN c_custkey % 4 = 0 THEN ' у парка' ELSE '' END)"
_NORM = f"trim(regexp_replace(lower({_NAME}), '^(ресторан |кафе )', ''), '«»\"')"
_ADDRESS = """concat('город ', n_name, CASE c_custkey % 6
  WHEN 0 THEN concat(', улица Зелёная ', c_nationkey) WHEN 1 THEN concat(', Сиреневый бульвар')
  WHEN 2 THEN concat(', пер. Узкий') WHEN 3 THEN concat(', пр. Мира') WHEN 4 THEN ', караул' ELSE ', Невское шоссе' END,
  CASE c_custkey % 4 WHEN 0 THEN concat(', дом ', c_custkey) WHEN 1 THEN concat(', д. ', c_custkey)
  WHEN 2 THEN concat(', владение ', c_custkey) ELSE '' END,
  CASE c_custkey % 3 WHEN 0 THEN concat(', стр. ', c_custkey % 9) WHEN 1 THEN ', корпус А' ELSE '' END)"""


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Register side: global_id, Name, Name_norm, coordinates."""
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("global_id"), F.expr(_NAME).alias("Name"), lon("s_suppkey").alias("x_coord"),
        lat("s_suppkey").alias("y_coord"),
    )
    return rows.withColumn("Name_norm", text.name_norm(F.col("Name")))


def customer_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Listing side: one row per customer, as taken from listing cards."""
    return table(spark, sf, "customer").select(
        F.expr(_TITLE).alias("title"),
        (F.col("c_custkey") % 6).cast("int").alias("rating"),
        F.col("c_mktsegment").alias("cuisine"),
        F.col("c_name").alias("phone"),
        F.concat(F.lit("https://venues.example.org/r/"), "c_custkey").alias("link"),
        F.lit("Москва").alias("city"),
        F.concat(F.lit("n"), "c_nationkey").alias("address"),
        F.lit("https://venues.example.org/restaurants/").alias("url"),
        F.lit("2031-02-03 04:05:06").alias("dttm"),
        F.lit("chunk.json").alias("fname"),
    )


def customer_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail side: pages of four customers in five, with coordinates, star map and review."""
    rows = table(spark, sf, "customer").where("c_custkey % 5 <> 4")
    stars = F.when(
        F.col("c_custkey") % 3 > 0,
        F.concat(F.lit('{"Еда":'), F.col("c_custkey") % 6, F.lit(',"Сервис":'), F.col("c_custkey") % 4, F.lit("}")),
    )
    review = F.when(F.col("c_custkey") % 4 > 0, F.concat("c_name", F.lit(". Хорошо. "), "c_mktsegment", F.lit(".")))
    return rows.select(
        F.concat(F.lit("https://venues.example.org/r/"), "c_custkey").alias("url"),
        F.lit("2022-09-10 10:00:00").alias("dttm"),
        F.lit("detail.json").alias("fname"),
        lon("c_custkey").alias("x_coord"),
        lat("c_custkey").alias("y_coord"),
        F.col("c_acctbal").cast("string").alias("avg_check"),
        F.lit("10-22").alias("opening_hours"),
        F.concat(F.lit("ул. "), "c_nationkey").alias("street_address"),
        F.lit("Москва").alias("street_locality"),
        stars.alias("aspect_stars"),
        review.alias("review"),
    )


_MATCHED = f"""SELECT c_custkey, global_id, distance FROM (SELECT c.c_custkey, s.global_id,
  {sql.haversine('s.x', 's.y', 'c.x', 'c.y')} AS distance, s.norm, c.title_norm
  FROM (SELECT s_suppkey AS global_id, {sql.lon('s_suppkey')} AS x, {sql.lat('s_suppkey')} AS y, {_NORM} AS norm FROM supplier) s,
  (SELECT c_custkey, {sql.lon('c_custkey')} AS x, {sql.lat('c_custkey')} AS y, lower({_TITLE}) AS title_norm FROM customer
   WHERE c_custkey % 5 <> 4) c)
  WHERE distance <= {RADIUS} AND (contains(title_norm, norm) OR contains(norm, title_norm))
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY distance, global_id) = 1"""


@query(
    f"SELECT s.k AS global_id, c.k AS custkey, {sql.rnd(sql.haversine('s.x', 's.y', 'c.x', 'c.y'), 4)} AS distance FROM "
    f"(SELECT s_suppkey AS k, {sql.lon('s_suppkey')} AS x, {sql.lat('s_suppkey')} AS y FROM supplier) s, "
    f"(SELECT c_custkey AS k, {sql.lon('c_custkey')} AS x, {sql.lat('c_custkey')} AS y FROM customer) c "
    f"WHERE {sql.haversine('s.x', 's.y', 'c.x', 'c.y')} <= {RADIUS}"
)
def geo_pairs(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), lon("c_custkey").alias("x_coord"), lat("c_custkey").alias("y_coord")
    )
    sellers = suppliers(spark, sf).select("global_id", "x_coord", "y_coord")
    pairs = match.distance_join(customers, sellers, RADIUS)
    return pairs.select("global_id", "custkey", rounded(F.col("distance"), 4).alias("distance"))


@query(f"SELECT c_custkey AS custkey, global_id, {sql.rnd('distance', 4)} AS distance FROM ({_MATCHED})")
def name_geo_match(spark: SparkSession, sf: str) -> DataFrame:
    joined = listing.with_details(customer_listing(spark, sf), customer_details(spark, sf))
    found = match.match_listing(joined, suppliers(spark, sf), RADIUS)
    key = F.regexp_extract("link", "([0-9]+)$", 1).cast("long")
    return found.select(key.alias("custkey"), "global_id", rounded(F.col("distance"), 4).alias("distance"))


@query(
    f"SELECT concat('https://venues.example.org/r/', c_custkey) AS url, '2022-09-10 10:00:00' AS dttm, "
    f"'detail.json' AS fname, {_TITLE} AS title, CAST(c_custkey % 6 AS INTEGER) AS rating, c_mktsegment AS cuisine, "
    f"c_name AS phone, 'Москва' AS city, concat('n', c_nationkey) AS address, {sql.rnd(sql.lon('c_custkey'), 6)} AS x_coord, "
    f"{sql.rnd(sql.lat('c_custkey'), 6)} AS y_coord, c_acctbal::VARCHAR AS avg_check, '10-22' AS opening_hours, concat('ул. ', c_nationkey) AS street_address, "
    f"'Москва' AS street_locality, global_id FROM customer JOIN ({_MATCHED}) USING (c_custkey)"
)
def match_main(spark: SparkSession, sf: str) -> DataFrame:
    matched = listing.matched_listing(
        customer_listing(spark, sf), customer_details(spark, sf), suppliers(spark, sf), RADIUS
    )
    main = listing.main_table(matched)
    return main.withColumns({c: rounded(F.col(c), 6) for c in ("x_coord", "y_coord")})


@query(
    f"SELECT global_id, a.aspect AS aspect_stars, concat('https://venues.example.org/r/', c_custkey) AS url, "
    f"CAST(c_custkey % a.m AS INTEGER) AS rating FROM ({_MATCHED}), (VALUES ('Еда', 6), ('Сервис', 4)) a(aspect, m) "
    "WHERE c_custkey % 3 > 0"
)
def match_star_aspects(spark: SparkSession, sf: str) -> DataFrame:
    matched = listing.matched_listing(
        customer_listing(spark, sf), customer_details(spark, sf), suppliers(spark, sf), RADIUS
    )
    return listing.star_aspects(matched)


@query(
    "SELECT global_id, s AS review, url, 'https://venues.example.org/' AS source, row_number() OVER (ORDER BY global_id, url, "
    "review, pos) - 1 AS sentence_id FROM (SELECT global_id, url, review, unnest(string_split(review, '.')) AS s, "
    "generate_subscripts(string_split(review, '.'), 1) AS pos FROM (SELECT global_id, "
    "concat('https://venues.example.org/r/', c_custkey) AS url, concat(c_name, '. Хорошо. ', c_mktsegment, '.') AS review "
    f"FROM ({_MATCHED}) JOIN customer USING (c_custkey) WHERE c_custkey % 4 > 0)) WHERE trim(s) <> ''"
)
def match_reviews(spark: SparkSession, sf: str) -> DataFrame:
    matched = listing.matched_listing(
        customer_listing(spark, sf), customer_details(spark, sf), suppliers(spark, sf), RADIUS
    )
    return listing.review_sentences(matched, "https://venues.example.org/")


# --- register ---------------------------------------------------------------------------------------------

_STREET_SQL = """CASE c_custkey % 6 WHEN 0 THEN 'улица' WHEN 1 THEN 'бульвар' WHEN 2 THEN 'переулок' WHEN 3 THEN 'проспект'
  WHEN 4 THEN NULL ELSE 'шоссе' END"""
_STREET_NAME_SQL = """CASE c_custkey % 6 WHEN 0 THEN concat('зелёная ', c_nationkey) WHEN 1 THEN 'сиреневый' WHEN 2 THEN 'узкий'
  WHEN 3 THEN 'мира' WHEN 4 THEN NULL ELSE 'невское' END"""


@query(
    f"""SELECT c_custkey, {_ADDRESS} AS Address,
  CASE WHEN street_hit THEN kind END AS StreetType, CASE WHEN street_hit THEN sname END AS StreetName,
  CASE c_custkey % 4 WHEN 0 THEN 'дом' WHEN 1 THEN 'дом' WHEN 2 THEN 'владение' END AS HouseType,
  CASE WHEN c_custkey % 4 < 3 THEN CAST(c_custkey AS VARCHAR) END AS HouseName,
  CASE c_custkey % 3 WHEN 0 THEN 'строение' WHEN 1 THEN 'корпус' END AS BuildingType,
  CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 9 AS VARCHAR) WHEN 1 THEN 'а' END AS BuildingName
  FROM (SELECT *, c_custkey % 6 <> 4 AS street_hit, {_STREET_SQL} AS kind, {_STREET_NAME_SQL} AS sname
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
)
def address_parts(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return with_address_parts(rows.select("c_custkey", F.expr(_ADDRESS).alias("Address")))


_KINDS = {
    "Street": "улица переулок шоссе аллея проспект площадь бульвар проезд тупик набережная".split(),
    "House": "дом владение участок".split(),
    "Building": "корпус строение здание".split(),
}
_TYPES = {
    part: f"CASE (p_partkey * {step} + p_size) % {len(kinds)} " + " ".join(f"WHEN {k} THEN '{kind}'" for k, kind in enumerate(kinds)) + " END"
    for (part, kinds), step in zip(_KINDS.items(), (1, 7, 5))
}
_ANY_ADDRESS = (
    f"concat(CASE WHEN p_partkey % 2 = 0 THEN concat({_TYPES['Street']}, ' садовая', p_size) ELSE concat('Садовая', p_size, ' ', {_TYPES['Street']}) END, "
    f"', ', {_TYPES['House']}, ' ', p_partkey, ', ', {_TYPES['Building']}, ' ', p_size)"
)


@query(
    f"SELECT p_partkey, {_ANY_ADDRESS} AS Address, {_TYPES['Street']} AS StreetType, concat('садовая', p_size) AS StreetName, {_TYPES['House']} AS HouseType, "
    f"p_partkey::VARCHAR AS HouseName, {_TYPES['Building']} AS BuildingType, p_size::VARCHAR AS BuildingName FROM part"
)
def address_types(spark: SparkSession, sf: str) -> DataFrame:
    """All types of streets, houses and buildings; the type before or after the street's name."""
    rows = table(spark, sf, "part").select("p_partkey", F.expr(_ANY_ADDRESS).alias("Address"))
    return with_address_parts(rows)


@query(f"SELECT s_suppkey AS global_id, {_NAME} AS Name, {_NORM} AS Name_norm FROM supplier")
def name_norm(spark: SparkSession, sf: str) -> DataFrame:
    return suppliers(spark, sf).select("global_id", "Name", "Name_norm")


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM (SELECT *, max(o_orderdate) OVER "
    "(PARTITION BY o_custkey) AS latest FROM orders) WHERE o_orderdate = latest AND o_orderpriority IN "
    "('1-URGENT', '2-HIGH', '5-LOW')"
)
def latest_version_filter(spark: SparkSession, sf: str) -> DataFrame:
    latest = register.latest_versions(table(spark, sf, "orders"), "o_custkey", "o_orderdate")
    return latest.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query(
    "SELECT c_custkey, company, CASE WHEN company IS NOT NULL THEN count(name) OVER (PARTITION BY company) END AS company_count "
    "FROM (SELECT c_custkey, CASE WHEN c_nationkey % 5 > 0 THEN c_mktsegment END AS company, "
    "CASE WHEN c_custkey % 7 > 0 THEN c_name END AS name FROM customer)"
)
def group_count_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 5 > 0, F.col("c_mktsegment")).alias("company"),
        F.when(F.col("c_custkey") % 7 > 0, F.col("c_name")).alias("name"),
    )
    return skew.with_group_values(rows, ["company"], company_count=F.count("name")).drop("name")


@query(
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 1 THEN o_orderpriority END AS phone, "
    "CASE WHEN o_orderkey % 5 > 1 THEN o_orderpriority END AS phones FROM orders"
)
def sentinel_to_null(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    printed = F.when(key % 3 == 0, F.lit("[]")).when(key % 3 == 1, F.lit("['нет телефона']")).otherwise(
        F.col("o_orderpriority")
    )
    listed = F.when(key % 5 == 0, F.array().cast("array<string>")).when(key % 5 == 1, F.array(F.lit("нет телефона")))
    listed = listed.otherwise(F.array("o_orderpriority"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").withColumn("l", listed)
    return rows.select(
        "o_orderkey",
        register.phone_or_null(printed, is_array=False).alias("phone"),
        register.phone_or_null(F.col("l"), is_array=True)[0].alias("phones"),
    )


@query(
    f"SELECT c_custkey AS global_id, CAST(c_nationkey AS INTEGER) AS Number, c_name AS Name, c_mktsegment AS TypeObject, c_mktsegment AS WebSite, "
    f"concat('1', c_custkey) AS phone1, concat('2', c_custkey) AS phone2, {sql.rnd(sql.lon('c_custkey'), 6)} AS x_coord, "
    f"{sql.rnd(sql.lat('c_custkey'), 6)} AS y_coord FROM customer"
)
def record_flatten(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "customer").select(
        F.concat(
            F.lit('{"global_id":'), "c_custkey", F.lit(',"Number":'), "c_nationkey", F.lit(',"Cells":{"Name":"'), "c_name",
            F.lit('","TypeObject":"'), "c_mktsegment", F.lit('","WebSite":"'), "c_mktsegment", F.lit('","PublicPhone":[{"PublicPhone":"1'), "c_custkey",
            F.lit('"},{"PrivatePhone":"2'), "c_custkey", F.lit('"}],"geoData":{"coordinates":['), lon("c_custkey"), F.lit(","),
            lat("c_custkey"), F.lit("]}}}"),
        ).alias("json")
    )
    # A field that the export has and this schema declares beside the usual ones.
    wider = schemas.REGISTER_RAW.replace("PublicPhone:", "WebSite: string, PublicPhone:")
    parsed = raw.select(F.from_json("json", wider).alias("r")).select("r.*")
    flat = register.flatten_register(parsed)
    return flat.select(
        "global_id", "Number", "Name", "TypeObject", "WebSite", F.col("PublicPhone")[0].alias("phone1"),
        F.col("PublicPhone")[1].alias("phone2"), rounded(F.col("x_coord"), 6).alias("x_coord"),
        rounded(F.col("y_coord"), 6).alias("y_coord"),
    )


@query(
    f"""WITH raw AS (SELECT s_suppkey // 2 AS global_id, CAST(s_suppkey % 2 AS INTEGER) AS Number, {_NAME} AS Name,
  CASE s_suppkey % 5 WHEN 0 THEN 'кафе' WHEN 1 THEN 'бар' WHEN 2 THEN 'ресторан' WHEN 3 THEN 'столовая' ELSE 'кафе' END AS TypeObject,
  CASE WHEN s_nationkey % 4 > 0 THEN concat('c', s_nationkey % 4) END AS OperatingCompany, {_NORM} AS Name_norm,
  CASE WHEN s_suppkey % 3 > 0 THEN concat('(495) ', s_suppkey, ',(499) ', s_nationkey) END AS PublicPhone FROM supplier),
kept AS (SELECT * FROM (SELECT *, max(Number) OVER (PARTITION BY global_id) AS m FROM raw) WHERE Number = m
  AND TypeObject IN ('кафе', 'бар', 'ресторан'))
SELECT global_id, Number, Name, TypeObject, OperatingCompany, Name_norm,
  CASE WHEN OperatingCompany IS NOT NULL THEN count(Name) OVER (PARTITION BY OperatingCompany) END AS OperatingCompany_count,
  count(Name_norm) OVER (PARTITION BY Name_norm) AS Name_norm_count, 'улица' AS StreetType,
  concat('номер ', global_id) AS StreetName, concat('Москва, Улица номер ', global_id, ', дом ', Number + 3, ', строение 2') AS Address, PublicPhone,
  'дом' AS HouseType, (Number + 3)::VARCHAR AS HouseName, 'строение' AS BuildingType, '2' AS BuildingName FROM kept"""
)
def register_mart(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    kinds = ["кафе", "бар", "ресторан", "столовая", "кафе"]
    raw = table(spark, sf, "supplier").select(
        F.floor(key / 2).alias("global_id"),
        (key % 2).cast("int").alias("Number"),
        F.expr(_NAME).alias("Name"),
        F.element_at(F.array(*[F.lit(k) for k in kinds]), (key % 5 + 1).cast("int")).alias("TypeObject"),
        F.when(F.col("s_nationkey") % 4 > 0, F.concat(F.lit("c"), F.col("s_nationkey") % 4)).alias("OperatingCompany"),
        F.concat(F.lit("Москва, Улица номер "), F.floor(key / 2), F.lit(", дом "), key % 2 + 3, F.lit(", строение 2")).alias("Address"),
        F.when(key % 3 > 0, F.array(F.concat(F.lit("(495) "), key), F.concat(F.lit("(499) "), "s_nationkey")))
        .otherwise(F.array(F.lit("нет телефона"))).alias("PublicPhone"),
    )
    return register.register_mart(raw).withColumn("PublicPhone", F.array_join("PublicPhone", ","))
