"""The kept frontier against the anti join with the whole cache."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart import schemas
from venuemart.functions.urls import cache_key
from venuemart.plans import jobs
from venuemart.sources import known, pages


def entries(spark, numbers, ok, dttm):
    rows = [(f"https://x.example.org/{i}", ok, dttm) for i in numbers]
    return spark.createDataFrame(rows, "url string, ok boolean, dttm string").withColumn("key", cache_key(F.col("url")))


def test_kept_frontier(spark, tmp_path):
    links = spark.createDataFrame([(i, f"https://x.example.org/{i}") for i in range(60)] + [(60, None), (61, "https://x.example.org/3")], "pos int, link string")
    held = known.KnownPages(spark, str(tmp_path / "state"), buckets=8, capacity=200)
    assert held.frontier(links).count() == 62
    runs = [entries(spark, range(0, 40, 2), True, "a"), entries(spark, range(0, 30, 3), False, "b"), entries(spark, range(0, 20), True, "c")]
    cache = None
    for run in runs:
        held.remember(run)
        cache = run if cache is None else cache.union(run)
        for limit in (None, 25):
            got, want = (sorted(map(tuple, x.collect()), key=repr) for x in (held.frontier(links, limit), pages.frontier(links, cache, limit)))
            assert got == want and got
    keys = links.select(cache_key(F.col("link")).alias("key")).where("key IS NOT NULL").distinct()
    newest = {r.key: r.dttm for r in held.newest(keys).collect()}
    assert sorted(newest.values()) == ["a"] * 10 + ["c"] * 20
    # Hardly a new link is looked up among the keys, however many there are of them.
    fresh = spark.range(2000).select(cache_key(F.concat(F.lit("https://y.example.org/"), "id")).alias("key"))
    assert held.suspected(fresh).count() < 100
    held.remember(runs[0])
    assert held.frontier(links).count() == pages.frontier(links, cache).count()


def test_full_filters_only_cost_lookups(spark, tmp_path):
    held = known.KnownPages(spark, str(tmp_path / "state"), buckets=1, capacity=1)
    held.remember(entries(spark, range(300), True, "a"))
    links = spark.createDataFrame([(i, f"https://x.example.org/{i}") for i in range(290, 310)], "pos int, link string")
    assert sorted(r.pos for r in held.frontier(links).collect()) == list(range(300, 310))


def test_frontier_job_with_kept_keys(spark, tmp_path):
    listing, state = str(tmp_path / "listing"), str(tmp_path / "state")
    rows = [(f"https://x.example.org/{i}", "f") for i in range(6)]
    fields = T.StructType.fromDDL(schemas.LISTING).fields
    data = spark.createDataFrame(rows, "link string, fname string")
    data.select(*[F.col(f.name) if f.name in ("link", "fname") else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).write.parquet(listing)
    for run, (new, left) in enumerate([([0, 1], [2, 3, 4, 5]), ([4], [2, 3, 5])]):
        cache, out = str(tmp_path / f"cache{run}"), str(tmp_path / f"out{run}")
        entries(spark, new, True, "a").drop("url").write.parquet(cache)
        jobs.page_frontier(spark, listing, cache, out, known=state)
        assert sorted(r.link for r in spark.read.parquet(out).collect()) == [f"https://x.example.org/{i}" for i in left]
