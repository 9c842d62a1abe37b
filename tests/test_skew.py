"""The split-up forms must give what the plain forms give."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from plantflow.operators import integrate, quality, sampling, skew
from plantflow.session import GROUP_ROWS_CONF


def skewed(spark, n=400, seed=1):
    """Readings of which one machine has most, at uneven times."""
    rng = random.Random(seed)
    rows, at = [], {"hot": 0, "a": 0, "b": 0}
    for i in range(n):
        key = "hot" if rng.random() < 0.7 else rng.choice("ab")
        at[key] += rng.choice([1, 60, 600, 4000, 20000])
        rows.append((key, at[key], None if rng.random() < 0.6 else float(rng.randint(0, 9)), i))
    df = spark.createDataFrame(rows, "machine_id string, s bigint, x double, i bigint")
    return df.withColumn("timestamp", F.timestamp_seconds("s"))


def test_fill_matches_pandas_in_both_forms(spark):
    df = skewed(spark)
    pdf = df.toPandas().sort_values(["machine_id", "s"])
    want = pdf.groupby("machine_id")["x"].transform(lambda s: s.ffill(limit=4).bfill(limit=4))
    want = dict(zip(pdf["i"], want.where(want.notna(), None)))
    for limit in ("1000000", "20", "7"):
        spark.conf.set(GROUP_ROWS_CONF, limit)
        got = {r.i: r.x for r in quality.fill_short_gaps(df, ["x"]).collect()}
        spark.conf.unset(GROUP_ROWS_CONF)
        assert len(got) == len(want)
        assert {k: v for k, v in got.items() if v is not None} == {k: v for k, v in want.items() if v is not None and v == v}


@pytest.mark.parametrize("limit", ["5", "23", "90"])
def test_segments_cover_lag_lead_and_rolling(spark, limit):
    df = skewed(spark, seed=int(limit))

    def body(frame, group):
        order = W.partitionBy(*group).orderBy("timestamp")
        return frame.withColumns(
            {"lag": F.lag("i").over(order), "lead": F.lead("i", 2).over(order), "mean": F.sum("i").over(order.rowsBetween(-9, -1))}
        )

    plain = body(df, ["machine_id"]).select("i", "lag", "lead", "mean")
    spark.conf.set(GROUP_ROWS_CONF, limit)
    cut = skew.over_segments(df, ["machine_id"], "timestamp", body, before=9, after=2).select("i", "lag", "lead", "mean")
    rows = sorted(map(tuple, cut.collect()))
    spark.conf.unset(GROUP_ROWS_CONF)
    assert rows == sorted(map(tuple, plain.collect()))


def test_exact_quantiles_split(spark, small_groups):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.choice(["h", "h", "h", "k"], 900), "x": rng.exponential(5, 900).round(2), "y": rng.normal(size=900)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = {r.g: r for r in skew.exact_quantiles(df, ["g"], ["x", "y"], [0.25, 0.5, 0.9]).collect()}
    for g, part in pdf.groupby("g"):
        for c in "xy":
            assert list(got[g][c]) == pytest.approx(list(part[c].quantile([0.25, 0.5, 0.9])))


def test_exact_quantiles_without_groups(spark, small_groups):
    df = spark.range(1001).select(((F.col("id") * 37) % 1001).cast("double").alias("x"))
    assert skew.exact_quantiles(df, [], ["x"], [0.0, 0.5, 1.0]).first().x == [0.0, 500.0, 1000.0]


def test_running_totals_split(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 3000).cast("double").alias("v"), (F.col("id") % 5).alias("n"))
    plain = sorted(map(tuple, skew.running_totals(df, ["g"], "v", ["n"], descending=True).select("g", "v", "n_upto", "n_all").collect()))
    spark.conf.set(GROUP_ROWS_CONF, "50")
    split = sorted(map(tuple, skew.running_totals(df, ["g"], "v", ["n"], descending=True).select("g", "v", "n_upto", "n_all").collect()))
    spark.conf.unset(GROUP_ROWS_CONF)
    assert split == plain


def history(spark, limit, probes, events):
    spark.conf.set(GROUP_ROWS_CONF, limit)
    rows = integrate.event_history(probes, events, "at", "at", "k", last="last", recent="recent").select("id", "last", "recent").collect()
    spark.conf.unset(GROUP_ROWS_CONF)
    return sorted(map(tuple, rows))


def test_event_history_forms_agree_with_brute_force(spark):
    rng = random.Random(8)
    day = 86400
    times = lambda n: [("hot" if rng.random() < 0.8 else "x", rng.randint(0, 30 * 24) * 3600) for _ in range(n)]
    probes = [(i, *p) for i, p in enumerate(times(150))]
    events = times(120)
    as_frame = lambda rows, schema: spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("s"))
    pf, ef = as_frame(probes, "id int, k string, s bigint"), as_frame(events, "k string, s bigint")
    want = []
    for i, k, s in probes:
        past = [e for q, e in events if q == k and e < s]
        want.append((i, round((s - max(past)) / day, 2) if past else None, sum(1 for e in past if e >= s - 7 * day)))
    for limit in ("1000000", "10"):
        got = history(spark, limit, pf, ef)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[2] for g in got] == [w[2] for w in want]
        assert [g[1] for g in got] == [pytest.approx(w[1], abs=0.011) if w[1] is not None else None for w in want]


def test_event_exactly_at_the_edges(spark):
    probes = spark.createDataFrame([("m", "2024-01-10 06:00:00")], "k string, t string").withColumn("at", F.col("t").cast("timestamp")).withColumn("id", F.lit(1))
    for t, recent in [("2024-01-10 06:00:00", 0), ("2024-01-03 06:00:00", 1), ("2024-01-03 05:59:59", 0)]:
        events = spark.createDataFrame([("m", t)], "k string, t string").withColumn("at", F.col("t").cast("timestamp"))
        for limit in ("1000000", "1"):
            assert history(spark, limit, probes, events)[0][2] == recent


def test_stratified_split_sizes(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    rows = sampling.stratified_split(df, "label", "id").groupBy("label", "split").count().collect()
    counts = {(r.label, r.split): r["count"] for r in rows}
    for label, n in ((0, 902), (1, 101)):
        train, validation = int(n * 0.6), int(n * 0.2)
        assert counts[label, "train"] == train
        assert counts[label, "validation"] == validation
        assert counts[label, "test"] == n - train - validation


def with_odd_keys(spark, n=300):
    """Rows of which a third have no key, with ties and a group without any value."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        key = rng.choice([None, "h", "h", "k"])
        rows.append((i, key, None if rng.random() < 0.2 else float(rng.randint(0, 20))))
    rows += [(n + i, "empty", None) for i in range(30)]
    return spark.createDataFrame(rows, "i bigint, g string, x double")


def in_both_forms(spark, limit, run):
    plain = sorted(map(tuple, run().collect()), key=repr)
    spark.conf.set(GROUP_ROWS_CONF, limit)
    split = sorted(map(tuple, run().collect()), key=repr)
    spark.conf.unset(GROUP_ROWS_CONF)
    return plain, split


def test_split_keeps_rows_without_label(spark):
    df = with_odd_keys(spark)
    got = sampling.stratified_split(df, "g", "i")
    assert got.count() == df.count()
    sizes = {(r.g, r.split): r["count"] for r in got.groupBy("g", "split").count().collect()}
    for g, n in df.groupBy("g").count().collect():
        assert sizes[g, "train"] == int(n * 0.6)


def test_quantiles_with_odd_groups(spark):
    df = with_odd_keys(spark)
    plain, split = in_both_forms(spark, "20", lambda: skew.exact_quantiles(df, ["g"], ["x"], [0.1, 0.5, 0.9]))
    as_lists = lambda rows: [(g, None if q is None else [v for v in q if v is not None]) for g, q in rows]
    assert as_lists(plain) == as_lists(split)
    assert len(plain) == 4


def test_running_totals_with_odd_groups(spark):
    df = with_odd_keys(spark).where("x IS NOT NULL").groupBy("g", "x").agg(F.count("*").alias("n"))
    plain, split = in_both_forms(spark, "5", lambda: skew.running_totals(df, ["g"], "x", ["n"]).select("g", "x", "n", "n_upto", "n_all"))
    assert plain == split and any(r[0] is None for r in split)


def test_median_of_rows_without_key_is_missing(spark):
    df = with_odd_keys(spark)
    plain, split = in_both_forms(spark, "20", lambda: quality.with_group_median(df, ["g"], ["x"]).select("i", "_median_x"))
    assert plain == split
    missing = {r.i for r in df.where("g IS NULL").collect()}
    assert all((m is None) == (i in missing or i >= 300) for i, m in plain)


def test_history_of_rows_without_key_is_empty(spark):
    rng = random.Random(2)
    at = lambda: rng.randint(0, 40) * 7200
    keys = [None, "hot", "hot", "a"]
    probes = spark.createDataFrame([(i, rng.choice(keys), at()) for i in range(200)], "i bigint, machine_id string, s bigint")
    events = spark.createDataFrame([(rng.choice(keys), at()) for _ in range(200)], "machine_id string, s bigint")
    probes, events = (f.withColumn("timestamp", F.timestamp_seconds("s")) for f in (probes, events))
    plain, split = in_both_forms(spark, "20", lambda: integrate.event_history(probes, events, "timestamp").drop("timestamp", "s"))
    assert plain == split
    assert all(r[2] is None and r[3] == 0 for r in plain if r[1] is None)


def test_bursts_are_cut(spark, small_groups):
    rows = [("m", 3_600_000_000 + i * 250_000, i) for i in range(900)]
    df = spark.createDataFrame(rows, "machine_id string, us bigint, i bigint").withColumn("timestamp", F.timestamp_micros("us"))
    sizes = {}

    def body(frame, group):
        sizes["largest"] = skew.largest_group(frame, group)
        return frame.withColumn("lag", F.lag("i").over(W.partitionBy(*group).orderBy("timestamp")))

    got = skew.over_segments(df, ["machine_id"], "timestamp", body, before=1)
    assert sorted((r.i, r.lag) for r in got.collect()) == [(i, i - 1 if i else None) for i in range(900)]
    assert sizes["largest"] <= 3 * small_groups


def test_broadcasts_have_a_bound_in_bytes(spark):
    small = spark.range(10).select("id", F.lit("x").alias("t"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(skew.checked_broadcast(small))
    spark.conf.set("spark.plantflow.maxBroadcastBytes", "100")
    assert not hinted(skew.checked_broadcast(small))
    spark.conf.unset("spark.plantflow.maxBroadcastBytes")


def test_only_local_sessions_get_a_folder_of_their_own():
    from plantflow import session

    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("spark://host:7077")


@pytest.mark.parametrize("sketch", [4, 20, 1_000])
def test_quantiles_by_bracket(spark, monkeypatch, sketch):
    """Heavy ties, groups far above and below the size of the sketch, empty and NULL groups, ends of the range."""
    monkeypatch.setattr(skew, "SKETCH", sketch)
    rng = np.random.default_rng(sketch)
    frames = {
        "ties": rng.choice([1.0, 1.0, 1.0, 2.0, 7.0], 3_000), "all one": np.full(700, 5.0), "spread": rng.normal(size=2_500),
        "steep": np.round(rng.exponential(3, 1_500) ** 4, 1), "few": np.array([3.0, 1.0, 2.0]), "single": np.array([9.0]), "none": np.array([np.nan]),
    }
    rows = [(g if g != "steep" else None, None if x != x else float(x), float(i % 7)) for g, xs in frames.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    got = {r.g: r for r in skew.bracket_quantiles(df, ["g"], ["x", "y"], shares).collect()}
    assert len(got) == len(frames)
    for g, xs in frames.items():
        found = got[g if g != "steep" else None]
        assert found.x == (None if g == "none" else pytest.approx(list(np.quantile(xs, shares))))
        assert found.y == pytest.approx(list(np.quantile(np.arange(len(xs)) % 7, shares)))
    whole = skew.bracket_quantiles(df, [], ["x", "y"], shares).first()
    assert whole.x == pytest.approx(list(np.quantile([r[1] for r in rows if r[1] is not None], shares)))
    assert [r.x for r in skew.bracket_quantiles(df.limit(0), [], ["x"], [0.5]).collect()] == [None]
    assert skew.bracket_quantiles(df.limit(0), ["g"], ["x"], [0.5]).collect() == []
