"""CSV with line breaks in quotes and JSON arrays, read by byte ranges, against readers that see the whole file."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from plantflow.sources import ranges, readers


@pytest.fixture(params=[150, 1 << 27])
def range_bytes(spark, request):
    """Files are cut into ranges of so many bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "1")
    yield request.param
    for n, v in zip(names, before):
        spark.conf.set(n, v)


rng = random.Random(5)
BITS = ["a", "b c", ",", '"', "\n", "\n\n", "é", "x" * 30, '",', ',"', "{", "}", "'", " "]


def field():
    return "".join(rng.choice(BITS) for _ in range(rng.randrange(5)))


def test_quoted_csv(spark, tmp_path, range_bytes):
    want = []
    for name in ("a", "b"):
        rows = [(f"{name}{i}", field(), rng.choice(["", "NA", field()]), str(i)) for i in range(12)]
        rows.append((f"{name}long", '"quoted ",\n' * 30, "", "0"))  # a field over several ranges
        rows += [(f"{name}{i}", "after", field(), "9") for i in range(100, 104)]
        out = io.StringIO()
        writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
        writer.writerows([("id", "note, long", "other", "n"), *rows])
        (tmp_path / f"{name}.csv").write_text(out.getvalue())
        want += rows
    found = ranges.read_quoted_csv(spark, str(tmp_path))
    assert found.columns == ["id", "note, long", "other", "n"]
    assert sorted((r[0], r[1] or "", r[2] or "", r[3]) for r in found.collect()) == sorted(want)
    assert not ranges.stray_quotes(spark, str(tmp_path))


def test_csv_shapes(spark, tmp_path):
    """Blank lines, line ends of other systems, no end of line at the end, a header only, nothing at all."""
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b\r\n1,x\r\n\r\n2,"y\nz"\r\n3,""\r\n4,last')
    rows = ranges.read_quoted_csv(spark, str(path)).collect()
    assert sorted((r.a, r.b or "") for r in rows) == [("1", "x"), ("2", "y\nz"), ("3", ""), ("4", "last")]
    path.write_text("a,b\n")
    only_header = ranges.read_quoted_csv(spark, str(path))
    assert only_header.columns == ["a", "b"] and only_header.collect() == []
    path.write_text("")
    assert ranges.read_quoted_csv(spark, str(path)).collect() == []
    (tmp_path / "d").mkdir()
    (tmp_path / "d/1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d/2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError):
        ranges.read_quoted_csv(spark, str(tmp_path / "d"))


def test_stray_quotes_are_read_by_one_task(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,a 5" pipe\n2,"x\ny"\n3,z\n')
    assert ranges.stray_quotes(spark, str(path))
    assert [(r.a, r.b) for r in readers.read_csv(spark, str(path), multi_line=True).orderBy("a").collect()] == [("1", 'a 5" pipe'), ("2", "x\ny"), ("3", "z")]


def test_one_csv_file_is_many_tasks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f'{i},"line\none {i}"\n' for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        pieces = ranges._pieces(spark, str(path), "\n", {})
        assert pieces.select("block").distinct().count() > 10
        rows = readers.read_csv(spark, str(path), multi_line=True)
        assert {(r.a, r.b) for r in rows.collect()} == {(str(i), f"line\none {i}") for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def value(depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 4:
        return {field(): value(depth + 1) for _ in range(rng.randrange(3))}
    if kind == 5:
        return [value(depth + 1) for _ in range(rng.randrange(3))]
    return [None, rng.random(), field(), rng.choice(["\\", '\\"', "}\\", '{"', '"}', '\\\\"', "[{]"])][kind]


@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays(spark, tmp_path, range_bytes, indent):
    want = []
    for name in ("a", "b"):
        rows = [{"id": f"{name}{i}", "x": value(), "y": field(), "z": {"p": value(), "q": i}} for i in range(12)]
        rows.append({"id": f"{name}long", "x": 1, "y": '}{\\"' * 60, "z": None})
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(indent)) + "\n" * (name == "a"))
        want += [(r["id"], r["y"], (r["z"] or {}).get("q")) for r in rows]
    schema = "id string, y string, z struct<q: long>"
    rows = readers.read_records(spark, str(tmp_path), schema)
    assert sorted((r.id, r.y, r.z.q if r.z else None) for r in rows.collect()) == sorted(want, key=lambda r: r[0])
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path))
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect()))


def test_json_shapes(spark, tmp_path):
    schema = "a long, b string"
    for text, want in {
        "": [], "[]": [], "[ ]\n": [], "[{}]": [], '{"a": 1}': [(1, None)], '[{"a": 1},\n{"a": 2, "b": "]"}]': [(1, None), (2, "]")],
        "{oops": [], "oops": [], '{"a": 1}\n{"a": 2}\n': [(1, None), (2, None)], '[{"a": "x", "b": "k"}]': [(None, "k")],
    }.items():
        (tmp_path / "t.json").write_text(text)
        assert sorted((r.a, r.b) for r in readers.read_records(spark, str(tmp_path / "t.json"), schema).collect() if r.a or r.b) == want, text
