"""Marts and jobs, from files to files."""

import json

import pytest
from pyspark.sql import functions as F

from venuemart import catalog, schemas
from venuemart.catalog import marts
from venuemart.plans import final, jobs, register, reviews
from venuemart.sources import files

def record(global_id, number, name, kind, address, phones=({"PublicPhone": "1"},), company="ООО"):
    return {"global_id": global_id, "Number": number, "Cells": {"Name": name, "TypeObject": kind, "Address": address, "OperatingCompany": company, "PublicPhone": list(phones), "geoData": {"coordinates": [37.6, 55.7]}}}


REGISTER = [
    record(1, 1, "Старое имя", "кафе", "город Москва, ул. Мира"),
    record(1, 2, "Кафе «Чебуречная»", "кафе", "город Москва, улица Мира, дом 1", [{"PublicPhone": "нет телефона"}], None),
    record(2345311202, 7, "Ресторан Сирень", "ресторан", "город Москва, Сиреневый бульвар, дом 15А"),
    record(3, 1, "Столовая", "столовая", "город Москва"),
]


def test_register_jobs(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "chunk_0.json").write_text(json.dumps(REGISTER[:2]), encoding="utf-8")
    (folder / "chunk_1.json").write_text(json.dumps(REGISTER[2:]), encoding="utf-8")
    flat, mart, direct = (str(tmp_path / n) for n in ("flat.csv", "mart", "direct"))
    jobs.process_register(spark, str(folder), flat)
    jobs.register_mart(spark, flat, mart)
    jobs.collect_register(spark, str(folder), direct)
    for path in (mart, direct):
        first, second = spark.read.parquet(path).orderBy("global_id").collect()
        assert first.PublicPhone is None and first.Name_norm == "чебуречная" and first.OperatingCompany_count is None
        assert (second.global_id, second.PublicPhone) == (2345311202, ["1"])
        assert (second.StreetType, second.StreetName, second.HouseType, second.HouseName) == ("бульвар", "сиреневый", "дом", "15а")
        assert second.x_coord == 37.6 and second.OperatingCompany_count == 1 and second.Name_norm_count == 1


def test_flatten_prefers_inner_ids(spark):
    rows = spark.createDataFrame([json.dumps({**REGISTER[0], "Cells": {**REGISTER[0]["Cells"], "global_id": 77}})], "string")
    raw = rows.select(F.from_json("value", schemas.REGISTER_RAW).alias("r")).select("r.*")
    assert register.flatten_register(raw).first().global_id == 77


def test_register_mart_of_nothing(spark):
    assert register.register_mart(spark.createDataFrame([], schemas.REGISTER)).count() == 0


@pytest.mark.parametrize("flatten, rows", [(False, 10), (True, 30)])
def test_concat_json(spark, tmp_path, flatten, rows):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for i in range(10):
        (folder / f"chunk_{i}.json").write_text(json.dumps([1, 2, 3] if flatten else {"data": [1, 2, 3]}))
    jobs.concat_data(spark, str(folder), out, "int" if flatten else "data array<int>", flatten)
    assert spark.read.json(out).count() == rows
    jobs.concat_data(spark, str(folder), out, "int" if flatten else "data array<int>", flatten, "csv")
    assert spark.read.option("header", True).csv(out).count() == rows


def test_empty_folder(spark, tmp_path):
    assert files.read_json_folder(spark, str(tmp_path), "a int").count() == 0
    assert files.read_by_name(spark, str(tmp_path), "a int, b string", "f").columns == ["a", "b", "f"]


def test_csv_by_name_reorders(spark, tmp_path):
    (tmp_path / "one file.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "two.csv").write_text("b,c,a\nz,9,2\n")
    got = files.read_by_name(spark, str(tmp_path), "a int, b string", "f", multi_line=True).orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(1, "x\ny"), (2, "z")] and got[1].f.endswith("two.csv")


def test_by_name_over_data_sets(spark, tmp_path):
    """Folders of either format, quoted commas in headers, missing columns; unknown files are an error."""
    df = spark.createDataFrame([(k, f"t{k}") for k in range(20)], "a int, `x,b` string")
    df.where("a < 8").repartition(4).write.option("header", True).csv(str(tmp_path / "one.csv"))
    df.where("a >= 8 and a < 15").repartition(2).write.parquet(str(tmp_path / "two"))
    (tmp_path / "three.csv").write_text('"x,b",a\n"q, r",99\n')
    got = files.read_by_name(spark, str(tmp_path), "a int, `x,b` string, none double", "f").collect()
    assert sorted((r.a, r["x,b"]) for r in got) == [*((k, f"t{k}") for k in range(15)), (99, "q, r")]
    assert {r.f.rsplit("/", 1)[1] for r in got} == {"one.csv", "two", "three.csv"}
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError):
        files.read_by_name(spark, str(tmp_path), "a int")
    with pytest.raises(FileNotFoundError):
        files.read_by_name(spark, str(tmp_path / "missing"), "a int")


@pytest.mark.parametrize("parts", [1, 4])
def test_ratings_do_not_depend_on_part_files(spark, tmp_path, parts):
    stars = spark.createDataFrame([(1, "food", "u", r) for r in (1, 1, 1, 5)], schemas.STAR_ASPECT)
    stars.repartition(parts).write.option("header", True).csv(str(tmp_path / "stars" / "a.csv"))
    jobs.collect_aspects(spark, str(tmp_path / "stars"), str(tmp_path / "rating"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "rating")).collect()] == [(1, 2.0)]


def test_concat_of_nested_values(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c.json").write_text('[{"a": 1}, {"a": 2}]')
    jobs.concat_data(spark, str(tmp_path / "in"), str(tmp_path / "out"), "array<struct<a: int>>")
    assert [[x.a for x in r.value] for r in spark.read.json(str(tmp_path / "out")).collect()] == [[1, 2]]


def test_listing_to_final_table(spark, tmp_path):
    """The whole chain over files: match, features, mentions, rollups, final table."""
    site = "https://venues.example.org/"
    rows = [("Чебуречная №1", 5, "кухня", "+7", f"{site}1", "Москва", "Мира", "p", "t", "a.json"), ("Иное", 1, "кухня", "+7", f"{site}2", "Москва", "Мира", "p", "t", "a.json")]
    spark.createDataFrame(rows, schemas.LISTING).write.parquet(str(tmp_path / "listing"))
    details = [(f"{site}{i}", "t", "d.json", 37.6001, 55.7, "1000", "10-22", "ул", "Москва", '{"Еда": 4, "Цена": 2}', "Вкусный шашлык. Рыба, рыба! . ") for i in (1, 2)]
    spark.createDataFrame(details, schemas.DETAILS).write.parquet(str(tmp_path / "details"))
    raw = spark.createDataFrame([json.dumps(r) for r in REGISTER], "string")
    flat = register.flatten_register(raw.select(F.from_json("value", schemas.REGISTER_RAW).alias("r")).select("r.*"))
    p = {n: str(tmp_path / n) for n in "mart main stars.csv reviews features mentions named rating final".split()}
    register.register_mart(flat).write.parquet(p["mart"])
    jobs.listing_mart(spark, str(tmp_path / "listing"), str(tmp_path / "details"), p["mart"], p["main"], str(tmp_path / "stars" / "s.csv"), p["reviews"], site)
    main = spark.read.parquet(p["main"]).collect()
    assert [(r.global_id, r.title, r.url) for r in main] == [(1, "Чебуречная №1", f"{site}1")]
    sentences = spark.read.parquet(p["reviews"]).orderBy("sentence_id").collect()
    assert [(r.sentence_id, r.review, r.source) for r in sentences] == [(0, "Вкусный шашлык", site), (1, " Рыба, рыба! ", site)]

    jobs.create_text_features(spark, p["reviews"], p["features"])
    jobs.create_aspects(spark, p["features"], str(tmp_path / "m" / "mentions.csv"))
    jobs.collect_named_aspects(spark, str(tmp_path / "m" / "mentions.csv"), p["named"])
    named = {(r.global_id, r.value): (r["count"], r.sentiment) for r in spark.read.parquet(p["named"]).collect()}
    assert named == {(1, "шашлык"): (1, 0.0), (1, "рыба"): (2, 0.0)}

    jobs.collect_aspects(spark, str(tmp_path / "stars" / "s.csv"), p["rating"])
    assert [tuple(r) for r in spark.read.parquet(p["rating"]).collect()] == [(1, 3.0)]
    jobs.create_final_dataset(spark, p["mart"], p["main"], p["rating"], p["final"])
    (row,) = spark.read.parquet(p["final"]).collect()
    assert (row.global_id, row.Name, row.rating, row.avg_check) == (1, "Кафе «Чебуречная»", 3.0, "1000")


def test_final_table_without_rating(spark):
    reg = spark.createDataFrame([(1, "n", "a", 5, "нет", 1.0, 2.0)], "global_id long, Name string, Address string, SeatsCount int, SocialPrivileges string, x_coord double, y_coord double")
    main = spark.createDataFrame([("u", "c", "p", "a", 1, "o"), ("v", "c", "p", "a", 9, "o")], "url string, cuisine string, phone string, avg_check string, global_id long, opening_hours string")
    ratings = spark.createDataFrame([], schemas.RATING)
    (row,) = final.final_table(reg, main, ratings).collect()
    assert row.url == "u" and row.rating == 0.0


def test_mean_of_means(spark):
    stars = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "a", 3), (1, "b", 5), (2, "b", 4), (None, "b", 1)], "global_id long, fname string, rating int")
    got = {r.global_id: r.rating for r in reviews.venue_ratings(stars).collect()}
    assert got == {1: 3.5, 2: 4.0}
    assert reviews.venue_ratings(stars, scaled=True).columns == ["global_id", "rating", "rating_boxcox_scaled"]


def test_training_set(spark):
    df = spark.createDataFrame([("Хорошо!", "positive"), ("123", "negative"), (None, "negative"), ("так", "neautral"), ("эх", "bad")], "review string, sentiment string")
    assert sorted(map(tuple, reviews.training_set(df, "rureviews").collect()), key=repr) == sorted([("хорошо", 1), ("так", 0), ("эх", None)], key=repr)
    other = spark.createDataFrame([("a", 2), ("b", 1), ("c", 0)], "review string, sentiment int")
    assert [r.sentiment for r in reviews.training_set(other, "senteval2016").orderBy("review").collect()] == [-1, 1, 0]
    with pytest.raises(ValueError):
        reviews.training_set(df, "unknown")


def test_sentiment_files(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("review\tsentiment\nДа\tpositive\n")
    for name, line in (("train", "раз\t1\n"), ("dev", "два\t2\n")):
        (tmp_path / f"{name}.tsv").write_text(line)
    outs = [str(tmp_path / "a"), str(tmp_path / "b")]
    jobs.load_sentiment(spark, str(tmp_path / "r.tsv"), [str(tmp_path / "train.tsv"), str(tmp_path / "dev.tsv")], *outs)
    jobs.transform_sentiments(spark, outs[1], "senteval2016", str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "c")).orderBy("sentiment").collect()
    assert [(r.review, r.sentiment) for r in got] == [("два", -1), ("раз", 1)]
    assert spark.read.parquet(outs[0]).first().review == "Да"


def test_large_inputs_are_dealt_to_several_files(spark, tmp_path, monkeypatch):
    """Rows that one task would have to sort go to files by ranges of their key, which may repeat; the rows read are the same."""
    texts = [(i // 2, f'line {i}\n"quoted", [x' * 20, "en", i) for i in range(200)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(3000).selectExpr("id DIV 3 AS l_orderkey", "int(1) AS l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(marts, "FILE_BYTES", 5_000)
    files_of = []
    frame = type(spark.range(1))
    deal = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda df, n, *by: files_of.append(n) or deal(df, n, *by))
    want = sorted((r[0], r[1]) for r in texts)
    for made in (marts.json_array_in_ranges, marts.csv_file_in_ranges):
        assert sorted((r.doc_id, r.text) for r in made(spark, str(tmp_path)).collect()) == want
    found = marts.json_numbers_in_ranges(spark, str(tmp_path)).collect()
    assert sorted(r.value for r in found) == sorted(i // 3 * 8 + 1 for i in range(3000))
    assert len(files_of) == 2 and min(files_of) > 1


def test_ranges_grow_with_the_files(spark, tmp_path, monkeypatch):
    """Few ranges of a large folder, many of a small one."""
    (tmp_path / "x.txt").write_text("line\n" * 400_000)
    with catalog.small_ranges(spark, str(tmp_path)):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "65536b"
    monkeypatch.setattr(catalog, "MANY_RANGES", 4)
    with catalog.small_ranges(spark, str(tmp_path)):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "500000b"
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() == 4


def test_training_set_cleans_a_text_once(spark):
    df = spark.createDataFrame([("Хорошо!", "positive")], "review string, sentiment string")
    plan = reviews.training_set(df, "rureviews")._jdf.queryExecution().optimizedPlan().toString()
    # Two patterns make a text clean; the test for blank texts must not have them again.
    assert plan.count("regexp_replace(") == 2
