"""CSV and JSON files read in byte ranges: the same rows from one range and from many."""

import csv
import io
import json
import random
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuemart.sources import files, ranges


@contextmanager
def range_size(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def csv_rows(rng, n):
    bits = ["a", "b,c", '"', '""', "\n", "\n\n", " ", "é", '"q"', "x\ny", ",", "long " * 30, '\n"\n']
    return [(k, "".join(rng.choices(bits, k=rng.randint(0, 5))) or "-", k * 0.5) for k in range(n)]


def write_csv(path, rows, end="\n", header=True):
    held = io.StringIO()
    out = csv.writer(held, lineterminator=end)
    if header:
        out.writerow(["id", "text", "value"])
    out.writerows(rows)
    path.write_bytes(held.getvalue().encode())


def wanted(rows):
    """As the fields read: a lone blank text stays."""
    return sorted((k, t, v) for k, t, v in rows)


def read(df):
    return sorted((r.id, r.text, r.value) for r in df.collect())


@pytest.mark.parametrize("size", [300, 4096, 10**7])
def test_csv_in_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    first, second = csv_rows(rng, 300), csv_rows(rng, 40)
    second[3] = (3, "giant " + 'line\n"quoted"\n' * 400, 1.5)
    write_csv(tmp_path / "a.csv", first)
    write_csv(tmp_path / "b.csv", second)
    with range_size(spark, size):
        df = files.read_csv(spark, str(tmp_path), "id long, text string, value double")
        assert read(df) == wanted(first + second)
        if size < 4096:
            pieces = ranges._pieces(spark, str(tmp_path), "\n")
            assert pieces.select("path", "at").distinct().count() > 10


def test_csv_line_ends_header_and_open_quote(spark, tmp_path):
    rows = [(1, "a", 0.5), (2, "b\r\nc", 1.0), (3, "d", 2.0)]
    write_csv(tmp_path / "a.csv", rows, "\r\n", header=False)
    with (tmp_path / "a.csv").open("ab") as f:
        f.write(b'\r\n\r\n4,"open\nend')
    for size in (8, 10**6):
        with range_size(spark, size):
            found = read(files.read_csv(spark, str(tmp_path), "id long, text string, value double", header=False))
        assert found[:3] == rows
        assert found[3][0] == 4 and "open\nend" in found[3][1]


def test_csv_like_the_csv_source(spark, tmp_path):
    """Nulls, empty fields, short and long records, and malformed numbers as Spark's own reader gives them."""
    (tmp_path / "a.csv").write_text('id,text,value\n1,,\n2,"",2\n3,x\n4,y,1,5\nz,w,1e3\n\n 6 , v ,7\n')
    schema = "id long, text string, value double"
    own = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path), schema).collect()), key=repr) == sorted(map(tuple, own.collect()), key=repr)


def test_csv_without_files_or_rows(spark, tmp_path):
    assert files.read_csv(spark, str(tmp_path), "id long").count() == 0
    (tmp_path / "a.csv").write_text("id\n")
    (tmp_path / "b.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path), "id long").count() == 0


def json_rows(rng, n):
    bits = ["a", "[", "]", "{", "}", ",", '"', "\\", "\\\\", '\\"', "é", "\n", "x" * 40, "],[", '"},{"']
    return [{"id": k, "text": "".join(rng.choices(bits, k=rng.randint(0, 6))), "tags": [rng.choice(bits) for _ in range(rng.randint(0, 3))]} for k in range(n)]


@pytest.mark.parametrize("size", [100, 4096])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_in_ranges(spark, tmp_path, size, indent):
    rng = random.Random(size)
    first, second = json_rows(rng, 200), json_rows(rng, 3)
    (tmp_path / "a.json").write_text(json.dumps(first, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(" \n" + json.dumps(second, indent=indent) + "\n")
    (tmp_path / "c.json").write_text(json.dumps({"id": 900, "text": "one, two", "tags": ["a, b", "]"]}, indent=indent))
    (tmp_path / "d.json").write_text("[]")
    (tmp_path / "e.json").write_text("")
    (tmp_path / "f.txt").write_text("[1]")
    with range_size(spark, size):
        found = files.read_json_arrays(spark, str(tmp_path), "id long, text string, tags array<string>", "path").collect()
    want = [(r["id"], r["text"], r["tags"]) for r in [*first, *second]] + [(900, "one, two", ["a, b", "]"])]
    assert sorted((r.id, r.text, r.tags) for r in found) == sorted(want)
    assert {r.path[-6:] for r in found} == {"a.json", "b.json", "c.json"}


@pytest.mark.parametrize("size", [16, 10**6])
def test_json_arrays_of_plain_values(spark, tmp_path, size):
    (tmp_path / "a.json").write_text(json.dumps([1, -2, None, 4]))
    (tmp_path / "b.json").write_text(json.dumps([k for k in range(50)], indent=1))
    with range_size(spark, size):
        assert sorted(r.value for r in files.read_json_values(spark, str(tmp_path), "long", True).where("value is not null").collect()) == sorted([1, -2, 4, *range(50)])
        (tmp_path / "a.json").write_text(json.dumps(["a,b", "[", '"', "\\"]))
        (tmp_path / "b.json").write_text(json.dumps([[1], [2, 3]]))
        found = sorted(r.value for r in ranges.json_values(spark, str(tmp_path)).collect())
        assert sorted(map(repr, map(json.loads, found))) == sorted(map(repr, ["a,b", "[", '"', "\\", [1], [2, 3]]))


def test_marks_of_escapes():
    outside, step, end = ranges._marks(np.frombuffer(rb'["a\"]b\\",[{}],"', np.uint8), 0)
    assert end == 1 and int(step[outside].sum()) == 1
    other, _, back = ranges._marks(np.frombuffer(b'x",[', np.uint8), 1)
    assert back == 0 and other.tolist() == [False, True, True, True]


def test_ranges_in_groups_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "MOST_RANGES", 2)
    rng = random.Random(1)
    rows = []
    for k in range(4):
        rows += (own := csv_rows(rng, 30))
        write_csv(tmp_path / f"{k}.csv", own)
    with range_size(spark, 200):
        assert read(files.read_csv(spark, str(tmp_path), "id long, text string, value double")) == wanted(rows)


def test_other_ranges_in_the_second_pass_are_an_error(spark, tmp_path):
    write_csv(tmp_path / "a.csv", csv_rows(random.Random(2), 300))
    with range_size(spark, 500):
        df = files.read_csv(spark, str(tmp_path), "id long, text string, value double")
    with range_size(spark, 333), pytest.raises(Exception, match="cut differently"):
        df.agg(F.count("id")).collect()
