"""The keys of all pages fetched so far, kept between runs, and the links they leave to be fetched.

Keys are kept in buckets by their hash, beside a Bloom filter of each bucket: words of 64 bits, those that are not
zero. A run adds files and rewrites none. New links are asked of the filters first, which take a few bytes a
key; only the links that a filter may know are looked up among the keys, in their buckets alone. The filters let no
known key pass as new, so the result is that of an anti join with all keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.functions.urls import cache_key
from venuemart.operators.ids import first_per_key

#: Bits of the filters per key, and bits that a key sets.
PER_KEY, PROBES = 10, 5


class KnownPages:
    """path: a folder on shared storage. A key beyond `capacity` costs more lookups, never a wrong result.

    `buckets` and `capacity` belong to the folder: give the same ones in every run.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024, capacity: int = 1_000_000_000):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.bits = max(64, -(-PER_KEY * capacity // buckets))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _probed(self, keys: DataFrame) -> DataFrame:
        """(key, bucket, word, mask): the bits of each key, those in one word together."""
        at = [F.pmod(F.xxhash64(F.lit(i + 1), "key"), F.lit(self.bits)) for i in range(PROBES)]
        bits = keys.select("key", self._bucket(), F.explode(F.array_distinct(F.array(*at))).alias("at"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))
        bits = bits.select("key", "bucket", F.expr("at div 64").alias("word"), bit.alias("mask"))
        return bits.groupBy("key", "bucket", "word").agg(F.bit_or("mask").alias("mask"))

    def _stored(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"{schema}, bucket int")
        return self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.path}/{name}")

    def remember(self, cache: DataFrame) -> None:
        """Add the entries of cache (key, ok, dttm) that are `ok`; others are forgotten, so their links come again.

        Entries that are known already may be added again. If it fails half-way, repeat it.
        """
        entries = cache.where(F.col("ok") & F.col("key").isNotNull()).select("key", F.col("dttm").cast("string").alias("dttm"), self._bucket())
        entries.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")
        words = self._probed(entries.select("key").distinct()).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        words.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/filters")

    def suspected(self, keys: DataFrame) -> DataFrame:
        """Those of the distinct `key`s that the filters may know, with their bucket: all known ones and few others."""
        words = self._stored("filters", "word long, bits long").groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        probed = self._probed(keys)
        met = probed.join(words, ["bucket", "word"], "left")
        here = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
        return met.groupBy("key", "bucket").agg(F.min(here).alias("all")).where("all").select("key", "bucket")

    def newest(self, keys: DataFrame) -> DataFrame:
        """(key, dttm): the newest entry of those of the distinct `key`s that are known."""
        met = self._stored("keys", "key string, dttm string").join(self.suspected(keys), ["bucket", "key"], "left_semi")
        return first_per_key(met.select("key", "dttm"), ["key"], [F.col("dttm").desc_nulls_last()])

    def frontier(self, links: DataFrame, limit: int | None = None, link: str = "link", pos: str = "pos") -> DataFrame:
        """Links still to be fetched, with `key`: those not known, among the first `limit` by position."""
        wanted = links if limit is None else links.orderBy(pos, link).limit(limit)
        keyed = wanted.withColumn("key", cache_key(F.col(link)))
        known = self.newest(keyed.select("key").where("key IS NOT NULL").distinct()).select("key")
        return keyed.join(known, "key", "left_anti").select(*links.columns, "key")
