"""Readers and writers. Every reader takes a declared schema, so empty folders are legal."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart.sources import ranges


def _schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def read_json_folder(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """A folder of `*.json` files, each holding one object or an array of objects (one row each)."""
    return (
        spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    )


def read_json_arrays(spark: SparkSession, folder: str, schema: str | T.StructType, source: str | None = None, glob: str = "*.json") -> DataFrame:
    """As `read_json_folder`, for files of any size: the elements of one array are read by many tasks.

    `source` names a column for the path of the file. Elements that do not fit the schema are rows of nulls.
    """
    wanted = _schema(schema)
    values = ranges.json_values(spark, folder, glob).select("path", F.from_json("value", wanted).alias("row"))
    return values.select("row.*", *([F.col("path").alias(source)] if source else []))


def read_json_values(spark: SparkSession, folder: str, value: str, flatten: bool, glob: str = "*.json") -> DataFrame:
    """A folder of `*.json` files holding any value of type `value`; with `flatten`, arrays of it.

    Gives one column `value`. Meant for arrays of plain values, which the JSON source cannot read. Arrays are read
    by many tasks, a file that is one value by one.
    """
    if flatten:
        found = ranges.json_values(spark, folder, glob)
        wrapped = F.from_json(F.concat(F.lit('{"v":'), F.col("value"), F.lit("}")), f"v {value}")
        return found.select(wrapped["v"].alias("value"))
    files = spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(folder)
    wrapped = F.from_json(F.concat(F.lit('{"v":'), F.col("value"), F.lit("}")), f"v {value}")
    return files.select(wrapped["v"].alias("value"))


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | T.StructType,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV, by default with quoted line breaks. Array, map and struct columns are read back from JSON text.

    A file of any size is read by many tasks, also with line breaks in quotes (`ranges.csv_records`); without
    them (`multi_line=False`) the files are read once instead of twice.
    """
    wanted = _schema(schema)
    raw = T.StructType([T.StructField(f.name, _flat_type(f.dataType), True) for f in wanted.fields])
    options = {"sep": sep, "quote": '"', "escape": '"'}
    if multi_line:
        records = ranges.csv_records(spark, paths)
        records = records.where("NOT first") if header else records
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.fields)
        df = records.select(F.from_csv("value", ddl, {**options, "multiLine": "true"}).alias("row")).select("row.*")
    else:
        df = spark.read.schema(raw).options(header=header, **options).csv(paths)
    nested = [f for f in wanted.fields if raw[f.name].dataType != f.dataType]
    return df.withColumns({f.name: F.from_json(f.name, f.dataType) for f in nested}) if nested else df


def _flat_type(t: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else t


def data_sets(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(path, format) of the data sets in a folder: files and folders of CSV or Parquet.

    A folder that holds part files itself is one data set. Hidden and marker files (`_`, `.`) do not count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(where) -> list:
        return [x for x in store.listStatus(where) if x.getPath().getName()[:1] not in "._"]

    def kind(name: str) -> str | None:
        return next((k for k in ("csv", "parquet") if name.rstrip("/").endswith(f".{k}") or f".{k}." in name), None)

    if not store.exists(path):
        raise FileNotFoundError(folder)
    if not store.getFileStatus(path).isDirectory():
        return [(folder, kind(path.getName()) or "csv")]
    inside = sorted(listed(path), key=lambda x: x.getPath().getName())
    if any(x.isFile() and x.getPath().getName().startswith("part-") for x in inside):
        return [(folder, kind(inside[0].getPath().getName()) or "csv")]
    found = []
    for x in inside:
        name = x.getPath().getName()
        form = next((k for y in listed(x.getPath()) if (k := kind(y.getPath().getName()))), None) if x.isDirectory() else kind(name)
        if form:
            found.append((x.getPath().toString(), form))
        elif not x.isDirectory() or listed(x.getPath()):
            raise ValueError(f"neither CSV nor Parquet: {x.getPath().toString()}")
    return found


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by their first line. A file's first line is the first row that its first split gives."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at")
    )
    first = lines.where("at = 0").withColumn("_id", F.monotonically_increasing_id()).groupBy("path")
    out: dict[str, list[str]] = {}
    for row in first.agg(F.min_by("value", "_id").alias("head")).toLocalIterator():
        out.setdefault(row["head"], []).append(unquote(row["path"]))
    return out


def read_by_name(spark: SparkSession, folder: str, schema: str | T.StructType, source: str | None = None, multi_line: bool = False):
    """All data sets of a folder, CSV and Parquet, columns matched by name; missing ones are NULL.

    `source` names a column for the path of the data set a row comes from, a file or a folder, however many
    part files that has. CSV headers may differ in the order of columns, also within a data set. An empty
    folder gives an empty table; something that is neither CSV nor Parquet is an error.
    """
    wanted = _schema(schema)
    kinds = {f.name: f for f in wanted.fields}
    out = None
    for path, form in data_sets(spark, folder):
        parts = []
        if form == "parquet":
            parts.append(spark.read.parquet(path))
        else:
            heads = _headers(spark, path)
            for head, paths in heads.items():
                names = next(csv.reader([head.lstrip("\ufeff").rstrip("\r")]), [])
                found = T.StructType([T.StructField(n, kinds[n].dataType if n in kinds else T.StringType()) for n in names])
                parts.append(read_csv(spark, path if len(heads) == 1 else paths, found, multi_line=multi_line))
        for part in parts:
            columns = [F.col(f"`{n}`").cast(f.dataType).alias(n) if n in part.columns else F.lit(None).cast(f.dataType).alias(n) for n, f in kinds.items()]
            part = part.select(*columns, *([F.lit(path).alias(source)] if source else []))
            out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([*wanted.fields, *([T.StructField(source, T.StringType())] if source else [])]))
    return out


def write(df: DataFrame, path: str, format: str = "json", mode: str = "overwrite") -> None:
    """Write as `json`, `parquet`, or (any other name) CSV with header, nested columns as JSON text."""
    if format == "json":
        df.write.mode(mode).json(path)
    elif format == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        write_csv(df, path, mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    nested = [f.name for f in df.schema.fields if _flat_type(f.dataType) != f.dataType]
    flat = df.withColumns({name: F.to_json(name) for name in nested}) if nested else df
    flat.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def with_file_name(df: DataFrame, name: str = "fname", full_path: bool = False) -> DataFrame:
    """Add the base name (or path) of the file a row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path" if full_path else "_metadata.file_name"))
