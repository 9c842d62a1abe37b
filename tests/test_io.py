import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plantflow.config import CHANNELS
from plantflow.operators import evaluate, integrate, quality
from plantflow.plans import inputs as tables
from plantflow.session import FILES_AT_ONCE_CONF
from plantflow.sources import folders, readers, schema, sinks, star_inputs as inputs
from plantflow.streaming import shifts
from tests import compare


def test_raw_csv_is_typed_and_validated(spark, sf_dir, tmp_path):
    sinks.write_table(inputs.sensor_raw(spark, sf_dir), str(tmp_path / "raw_sensor_data.csv"), format="csv")
    sinks.write_table(inputs.maintenance_raw(spark, sf_dir), str(tmp_path / "raw_maintenance_data.csv"), format="csv")
    raw = readers.read_raw_sensor(spark, str(tmp_path))
    assert dict(raw.dtypes)["temperature_k"] == "double" and dict(raw.dtypes)["failure_flag"] == "bigint"
    assert raw.count() == inputs.sensor_raw(spark, sf_dir).count()
    assert readers.read_raw_maintenance(spark, str(tmp_path)).count() > 0
    with pytest.raises(FileNotFoundError):
        readers.read_raw_production(spark, str(tmp_path))


def test_csv_columns_go_by_name(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    spark.createDataFrame([("x", "1"), ("y", "bad")], "b string, a string").write.option("header", True).csv(path)
    from pyspark.sql import types as T

    typed = readers.read_csv(spark, path, T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]))
    assert sorted(map(tuple, typed.collect()), key=repr) == [(1, "x"), (None, "y")]


def test_bad_raw_table_is_refused(spark, tmp_path):
    spark.createDataFrame([("M-1",)], "machine_id string").write.option("header", True).csv(str(tmp_path / "raw_sensor_data.csv"))
    with pytest.raises(schema.SchemaValidationError):
        readers.read_raw_sensor(spark, str(tmp_path))


def test_split_table_prunes(spark, tmp_path):
    df = spark.createDataFrame([("train", 1), ("test", 2)], "split string, x int")
    sinks.write_splits(df, str(tmp_path / "t"))
    test = readers.read_splits(spark, str(tmp_path / "t")).filter("split = 'test'")
    assert [r.x for r in test.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()


def test_json_array_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"machine_id": "M-1", "x": 1.5}, {"machine_id": "M-2", "x": null}]')
    (tmp_path / "bad.json").write_text("{oops")
    assert readers.read_records(spark, str(tmp_path / "r.json"), "machine_id string, x double").count() == 2
    assert readers.read_records(spark, str(tmp_path / "bad.json"), "machine_id string, x double").count() == 0
    assert readers.read_records(spark, str(tmp_path / "none.json"), "machine_id string, x double").count() == 0


def test_page_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("page one\f  \fpage three")
    (tmp_path / "b.txt").write_text("")
    pages = readers.read_page_files(spark, str(tmp_path))
    assert sorted((r.document, r.page, r.text) for r in pages.collect()) == [("a.txt", 1, "page one"), ("a.txt", 3, "page three")]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "c.txt").write_text(" \f\n")
    with pytest.raises(ValueError):
        readers.read_page_files(spark, str(empty))


def test_text_files_lie_in_one_folder_one_a_row(spark, tmp_path):
    texts = spark.createDataFrame([(f"first {i}\fsecond {i}",) for i in range(40)], "value string").repartition(3)
    sinks.write_text_files(texts, str(tmp_path / "files"), "\f")
    assert len(list((tmp_path / "files").glob("part-*"))) == 40
    pages = readers.read_page_files(spark, str(tmp_path / "files")).collect()
    assert len({r.document for r in pages}) == 40
    assert sorted((r.page, r.text) for r in pages) == sorted((n, f"{t} {i}") for n, t in ((1, "first"), (2, "second")) for i in range(40))


@pytest.fixture
def few_files(spark):
    """Let the driver list no more than ten files at once."""
    spark.conf.set(FILES_AT_ONCE_CONF, "10")
    yield 10
    spark.conf.unset(FILES_AT_ONCE_CONF)


def test_the_driver_holds_few_page_files_at_a_time(spark, tmp_path, few_files):
    texts = spark.createDataFrame([(f"first {i}\f \fthird {i}",) for i in range(64)], "value string").repartition(3)
    sinks.write_text_files(texts, str(tmp_path / "files"), "\f", folders=True)
    assert max(len(list(f.glob("part-*"))) for f in (tmp_path / "files").glob("folder=*")) == few_files
    (tmp_path / "files/folder=0-0/odd.txt").write_bytes(b"\xff\xfe\x00bad")
    lists = [[len(list(Path(p.removeprefix("file:")).glob("*.txt"))) for p in block.paths] for block in folders.blocks(spark, str(tmp_path / "files"))]
    assert sum(map(sum, lists)) == 65 and all(sum(n) <= few_files or len(n) == 1 for n in lists)

    pages = readers.read_page_files(spark, str(tmp_path / "files"))
    assert "binaryFile" not in pages._jdf.queryExecution().toString()  # no plan is left that lists every file
    rows = pages.collect()
    assert len({r.document for r in rows}) == 64
    assert sorted((r.page, r.text) for r in rows) == sorted((n, f"{t} {i}") for n, t in ((1, "first"), (3, "third")) for i in range(64))
    assert [tuple(r) for r in readers.unreadable_page_files(spark, str(tmp_path / "files")).collect()] == [("folder=0-0/odd.txt", "not text in UTF-8")]
    assert all(spark.conf.get(k) != v for k, v in folders.SMALL_FILES.items())


def test_page_files_in_many_folders_without_text_are_an_error(spark, tmp_path, few_files):
    for i in range(24):
        (tmp_path / f"of={i % 4}").mkdir(exist_ok=True)
        (tmp_path / f"of={i % 4}/{i}.txt").write_text(" \f")
    assert len(list(folders.blocks(spark, str(tmp_path)))) == 4
    with pytest.raises(ValueError):
        readers.read_page_files(spark, str(tmp_path))
    (tmp_path / "of=3/23.txt").write_text("page")
    assert [tuple(r) for r in readers.read_page_files(spark, str(tmp_path / "of=*"), ["page", "text"]).collect()] == [(1, "page")]


def test_page_files_query_leaves_no_list_of_files(spark, sf_dir, few_files):
    from plantflow.plans import catalog

    pages = catalog.QUERIES["page_files"](spark, sf_dir)
    assert "binaryFile" not in pages._jdf.queryExecution().toString()
    assert compare.difference(compare.spark_rows(pages), compare.sql_rows(compare.duck(sf_dir), catalog.SQL["page_files"])) is None


def test_labelled_assets(spark):
    df = spark.createDataFrame([("a", "normal", "train"), ("b", "defect", "test"), ("c", "odd", "train")], "image_path string, label string, split string")
    assert {r.image_path: r.label_code for r in readers.labelled_assets(df, "train").collect()} == {"a": 0, "c": None}


def test_registry_versions(spark, tmp_path):
    metrics = spark.createDataFrame([("a", "validation", 0.5), ("b", "validation", 0.7)], "model string, split string, f1 double")
    best = evaluate.best_model(metrics, ["a", "b"])
    for version in (1, 2):
        row = sinks.register_model(best, str(tmp_path / "reg"), "p", "run", "F1").first()
        assert (row.selected_model, row.version) == ("b", version)


def test_stream_equals_batch_on_closed_shifts(spark, sf_dir, tmp_path):
    stream = shifts.stream_shift_aggregate(inputs.sensor_from_events(inputs.event_stream(spark, sf_dir)))
    shifts.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    closed = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = shifts.stream_shift_aggregate(inputs.sensor_raw(spark, sf_dir))
    keys = ["machine_id", "date", "shift", "failure_occurred_this_shift"]
    got, want = set(map(tuple, closed.select(*keys).collect())), set(map(tuple, batch.select(*keys).collect()))
    assert got <= want and 0 < len(want) - len(got) <= 15
    sums = lambda df: df.agg(F.sum("vibration_mm_s_mean")).first()[0]
    last = closed.agg(F.max("shift_start")).first()[0]
    assert sums(closed) == pytest.approx(sums(batch.filter(F.col("shift_start") <= last)))


def test_stream_keeps_different_readings_of_one_instant(spark, tmp_path):
    """Two readings at one instant both count, copies count once, and a late reading is reported."""
    def reading(time, value, flag=0, status="RUNNING"):
        return ("M-1", "PRESS", time, *[value] * len(CHANNELS), status, flag)

    columns = ["machine_id string", "machine_type string", "timestamp string", *[f"{c} double" for c in CHANNELS], "operating_status string", "failure_flag int"]
    first = [
        reading("2024-01-01 07:00:00", 300.0), reading("2024-01-01 07:00:00", 301.0, 1), reading("2024-01-01 07:00:00", 300.0, status=" running\t"),
        reading("2024-01-01 08:00:00", 302.0), reading("2024-01-01 08:00:00", -9e9), reading("2024-01-01 08:00:00", -8e9),
        reading("2024-01-02 12:00:00", 300.0),
    ]
    # a batch judges lateness by the watermark that the batch before it began with
    next_, late = [reading("2024-01-02 12:10:00", 300.0)], [reading("2024-01-01 09:00:00", 310.0), reading("2024-01-02 12:30:00", 300.0)]
    for k, rows in enumerate((first, next_, late)):
        spark.createDataFrame(rows, ", ".join(columns)).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        time.sleep(1.1)  # files are read in the order of their times
    source = spark.readStream.schema(", ".join(columns)).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    stream = shifts.stream_shift_aggregate(source)
    run = shifts.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    run.awaitTermination()
    assert shifts.late_rows(run) == 1

    raw = spark.createDataFrame(first[:-1], ", ".join(columns))
    typed = raw.withColumns({"operating_status": F.upper(F.trim(F.regexp_replace("operating_status", "\t", ""))), "timestamp": F.col("timestamp").cast("timestamp")})
    want = integrate.aggregate_to_shift(quality.cleaned(quality.null_outside_bounds(typed.distinct())))
    closed = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).select(want.columns)
    batch = shifts.stream_shift_aggregate(raw).select(want.columns)
    assert closed.collect() == want.collect() == batch.collect()
    assert closed.first().failure_occurred_this_shift == 1


def test_window_and_hour_rules_agree(spark, sf_dir):
    readings = quality.cleaned(quality.null_outside_bounds(inputs.sensor_raw(spark, sf_dir).withColumn("timestamp", F.col("timestamp").try_cast("timestamp")).filter("timestamp is not null").dropDuplicates(["machine_id", "timestamp"])))
    by_rule = integrate.aggregate_to_shift(readings).select("machine_id", "date", "shift", "failure_occurred_this_shift")
    by_window = shifts.stream_shift_aggregate(inputs.sensor_raw(spark, sf_dir)).select("machine_id", "date", "shift", "failure_occurred_this_shift")
    assert by_rule.exceptAll(by_window).isEmpty() and by_window.exceptAll(by_rule).isEmpty()


def test_feature_table_has_no_leakage(spark, sf_dir):
    """Changing the last split's readings must not change any training row."""
    features = tables.feature_table(spark, sf_dir)
    assert features.groupBy("machine_id", "date", "shift").count().filter("count > 1").isEmpty()
    assert {r.split for r in features.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_csv_as_spreadsheets_write_it(spark, tmp_path):
    path = tmp_path / "raw_maintenance_data.csv"
    path.write_text(
        'machine_id,timestamp,maintenance_type,incident_type,maintenance_note,urgency\n'
        'M-1,2024-01-01 00:00:00,Corrective,Quality,"he said ""stop, now"" twice\nand left",NA\n'
        'M-2,2024-01-02 00:00:00,Corrective,Quality,plain,nan\n'
    )
    rows = readers.read_raw_maintenance(spark, str(tmp_path)).orderBy("machine_id").collect()
    assert [r.maintenance_note for r in rows] == ['he said "stop, now" twice\nand left', "plain"]
    assert [r.urgency for r in rows] == [None, None]


def test_broken_json_records_are_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x"}, {"a": "odd", "b": "y"}]')
    (tmp_path / "b.json").write_text("oops")
    rows = readers.read_records(spark, str(tmp_path), "a long, b string").collect()
    assert sorted((r.b, r.a) for r in rows) == [("x", 1), ("y", None)]
    assert readers.unreadable_records(spark, str(tmp_path), "a long, b string").first().n == 3


def test_two_writers_get_two_versions(spark, tmp_path):
    """Both read the registry while it is empty; each still gets a version of its own."""
    from concurrent.futures import ThreadPoolExecutor

    best = spark.createDataFrame([("a", 0.5)], "model string, f1 double")
    with ThreadPoolExecutor(4) as pool:
        rows = list(pool.map(lambda i: sinks.register_model(best, str(tmp_path / "reg"), "p", f"run-{i}", "F1").first(), range(4)))
    assert sorted(r.version for r in rows) == [1, 2, 3, 4]
    stored = spark.read.parquet(str(tmp_path / "reg")).collect()
    assert sorted((r.version, r.source_run_id) for r in stored) == sorted((r.version, r.source_run_id) for r in rows)
    assert sinks.register_model(best, str(tmp_path / "reg"), "other", "run", "F1").first().version == 1
    with ThreadPoolExecutor(8) as pool:
        for i in range(20):
            assert sum(pool.map(lambda _: sinks.claim(spark, str(tmp_path / f"x/{i}")), range(8))) == 1


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "audit"), "decision_id string, n long"
    one, two = (spark.createDataFrame(rows, schema) for rows in ([("a", 1), ("b", None)], [("c", 3)]))
    assert sinks.append_audit(one, path, "s-0") and not sinks.append_audit(one, path, "s-0")
    sinks.append_audit(two, path)
    read = lambda: sorted(r.decision_id for r in sinks.read_audit(spark, path, one.schema).collect())
    assert read() == ["a", "b", "c"]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:  # four writers of one batch
        assert sum(pool.map(lambda _: sinks.append_audit(two, path, "s-1"), range(4))) == 1
    assert read() == ["a", "b", "c", "c"]


def test_audit_of_a_stream(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "decision_id string, n long")
    one.write.parquet(str(tmp_path / "in"))
    for checkpoint in ("one", "two"):  # a lost checkpoint runs the same batch again
        source = spark.readStream.schema(one.schema).parquet(str(tmp_path / "in"))
        sinks.audit_stream(source, str(tmp_path / "audit"), str(tmp_path / checkpoint)).awaitTermination()
    assert sinks.read_audit(spark, str(tmp_path / "audit"), one.schema).count() == 2


def test_page_files_that_cannot_be_read_are_named(spark, tmp_path):
    (tmp_path / "a.txt").write_text("page")
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe\x00bad")
    (tmp_path / "c.txt").write_text(" \f ")
    assert [r.document for r in readers.read_page_files(spark, str(tmp_path)).collect()] == ["a.txt"]
    assert {(r.document, r.reason) for r in readers.unreadable_page_files(spark, str(tmp_path)).collect()} == {
        ("b.txt", "not text in UTF-8"), ("c.txt", "no text")
    }
