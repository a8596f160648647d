"""Late rows: whatever the order of the files and the size of a batch, the tables are the same."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks.operators import ordered
from lodeworks.session import work_path
from lodeworks.streaming import io, late


def _events(n=600, seed=11):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.integers(0, 4 * 86_400, n))
    return pd.DataFrame(
        {
            "event_id": np.arange(n),
            "ts": (np.datetime64("2024-03-01") + t.astype("timedelta64[s]")).astype("datetime64[us]"),
            "device": np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n)),
            "state": rng.choice(["on", "off", "idle"], n),
            "value": np.where(rng.random(n) < 0.05, np.nan, np.round(rng.normal(1e6, 1, n), 3)),
        }
    )


@pytest.fixture(scope="module")
def pdf():
    return _events()


@pytest.fixture(scope="module", params=["one batch", "a file a batch"])
def stream(request, spark, pdf, tmp_path_factory):
    """Five files whose event times are out of order, and overlap."""
    folder = tmp_path_factory.mktemp("shuffled")
    order = np.random.default_rng(3).permutation(len(pdf) // 40)
    for no, chunk in enumerate(np.array_split(order, 5)):
        rows = pdf[np.isin(np.arange(len(pdf)) // 40, chunk)]
        spark.createDataFrame(rows).withColumn("value", F.when(~F.isnan("value"), F.col("value"))).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode(
            "append"
        ).parquet(str(folder / "events.parquet"))
    size = {"one batch": 1000, "a file a batch": 1}[request.param]
    return lambda: io.stream_table(spark, str(folder), "events", size).withColumn("ts", F.col("ts").cast("timestamp"))


def _closed(pdf, minutes=10):
    return pdf["ts"].max() - pd.Timedelta(minutes=minutes)


def test_windows_hold_every_row(stream, pdf):
    got = late.run_aggregates(stream(), "device", "6 hours", "t").toPandas()
    w = pdf.assign(w=pdf["ts"].dt.floor("6h"))
    w = w[w["w"] + pd.Timedelta("6h") <= _closed(pdf)].groupby(["device", "w"])["value"]
    want = pd.DataFrame({"n": w.size(), "avg": w.mean(), "lo": w.min(), "hi": w.max()}).reset_index()
    assert len(got) == len(want) > 30
    got = got.sort_values(["device", "window_start"], ignore_index=True)
    assert (got["device"] == want["device"]).all() and (got["window_start"] == want["w"]).all() and (got["n"] == want["n"]).all()
    assert np.allclose(got["avg_value"], want["avg"], atol=1e-4, equal_nan=True) and np.allclose(got["min_value"], want["lo"], equal_nan=True)
    assert np.allclose(got["max_value"], want["hi"], equal_nan=True) and (got["window_end"] - got["window_start"] == pd.Timedelta("6h")).all()


def test_sliding_statistics_are_the_sample_deviation(stream, pdf):
    got = late.run_stats(stream(), "device", "24 hours", "6 hours", "s").toPandas()
    want = {}
    for end in pd.date_range("2024-03-01 06:00", "2024-03-06", freq="6h"):
        part = pdf[(pdf["ts"] >= end - pd.Timedelta("24h")) & (pdf["ts"] < end) & pdf["value"].notna()]
        if end <= _closed(pdf):
            want |= {(d, end): (v.mean(), v.std()) for d, v in part.groupby("device")["value"]}
    assert len(got) == len(want) > 20
    for r in got.itertuples():
        mean, sigma = want[r.device, r.window_end]
        assert r.mean == pytest.approx(mean, abs=1e-6) and r.sigma == pytest.approx(sigma, rel=1e-6, nan_ok=True)


def test_heartbeats_arriving_late_end_a_silence(stream, pdf):
    silence = pd.Timedelta("2h")
    got = late.run_heartbeat(stream(), "device", 7200, "h").toPandas()
    want = []
    for device, part in pdf.groupby("device"):
        ts = part["ts"].sort_values()
        want += [(device, x + silence) for x in ts[(ts.shift(-1) - ts) > silence]]
        if ts.max() + silence < _closed(pdf):
            want.append((device, ts.max() + silence))
    assert len(want) > 5 and sorted(zip(got["device"], got["offline_at"], strict=True)) == sorted(want)
    assert got["value"].isna().all()


def test_glitches_follow_the_order_of_events_not_of_files(stream, pdf):
    rows = late.run_rows(stream().select("device", "state", "event_id", "ts"), "g")
    got = ordered.glitches(rows, "device", "state", ["ts", "event_id"], 3, 3600)
    assert got.columns == ["device", "state", "event_id", "ts"]
    want = []
    for _, part in pdf.sort_values(["ts", "event_id"]).groupby("device"):
        moved = part[(part["state"] != part["state"].shift(1)) & part["state"].shift(1).notna()]
        want += moved.loc[(moved["ts"] - moved["ts"].shift(2)).dt.total_seconds() <= 3600, "event_id"].tolist()
    assert len(want) > 20 and sorted(r.event_id for r in got.collect()) == sorted(want)


def test_replays_are_dropped_between_batches(stream, pdf):
    twice = stream().unionByName(stream())
    assert sorted(r.event_id for r in late.run_distinct(twice, ["event_id"], "d").collect()) == list(range(len(pdf)))


def _file(spark, folder, rows):
    spark.createDataFrame(rows, "ts timestamp, device string, value double").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def _at(hour, day=1):
    return pd.Timestamp(f"2024-03-{day:02d} {hour:02d}:30:00").to_pydatetime()


def test_a_late_row_reopens_its_day_only(spark, tmp_path):
    path = work_path(spark, "late")
    files = lambda: {str(f): f.stat().st_mtime_ns for f in __import__("pathlib").Path(path).glob("closed/day=*/*.parquet")}
    run = lambda: late.run_aggregates(io.stream_table(spark, str(tmp_path), "events"), "device", "1 hour", "late", path=path)
    _file(spark, tmp_path, [(_at(1), "a", 1.0), (_at(2), "a", 2.0), (_at(5, 2), "a", 3.0), (_at(5, 3), "a", 4.0)])
    first = {(r.window_start.day, r.window_start.hour): r.n for r in run().collect()}
    assert first == {(1, 1): 1, (1, 2): 1, (2, 5): 1}
    before = files()
    # One row of a closed day, one of an open hour; a row without a time belongs to no window.
    _file(spark, tmp_path, [(_at(2), "a", 8.0), (_at(5, 3), "b", 5.0), (None, "a", 1.0)])
    again = {(r.window_start.day, r.window_start.hour, r.avg_value): r.n for r in run().collect()}
    assert again == {(1, 1, 1.0): 1, (1, 2, 5.0): 2, (2, 5, 3.0): 1}
    after = files()
    assert {f for f in before if "day=2024-03-02" in f} <= set(after) and not [f for f in before if "day=2024-03-01" in f and f in after]
    report = {r.batch: (r.rows, r.late_rows, r.behind_micros) for r in late.late_report(spark, path).collect()}
    behind = (pd.Timestamp("2024-03-03 05:20") - pd.Timestamp("2024-03-01 02:30")) // pd.Timedelta("1us")
    assert report == {0: (4, 0, None), 1: (3, 1, behind)}
    assert [r.value for r in late.late_rows(spark, path).collect()] == [8.0]
    # Nothing new: nothing changes.
    assert len(run().collect()) == 3 and files() == after


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    path = work_path(spark, "repeated")
    _file(spark, tmp_path, [(_at(1), "a", 1.0), (_at(5), "a", 3.0)])

    def twice(stream, label, handle, checkpoint=None):
        io.run_batches(stream, label, lambda batch, no: (handle(batch, no), handle(batch, no)), checkpoint)

    monkeypatch.setattr(late, "run_batches", twice)
    rows = late.run_aggregates(io.stream_table(spark, str(tmp_path), "events"), "device", "1 hour", "repeated", path=path).collect()
    assert [(r.window_start.hour, r.n) for r in rows] == [(1, 1)]
    stream = io.stream_table(spark, str(tmp_path), "events")
    assert late.run_distinct(stream, ["device"], "r").count() == 2 and late.run_rows(stream, "r").count() == 2


def test_empty_streams(spark, tmp_path):
    _file(spark, tmp_path, [])
    stream = lambda: io.stream_table(spark, str(tmp_path), "events")
    assert late.run_aggregates(stream(), "device", "1 hour", "e").columns == ["device", "window_start", "window_end", "n", "avg_value", "min_value", "max_value"]
    assert late.run_stats(stream(), "device", "2 hours", "1 hour", "e").count() == 0
    assert late.run_heartbeat(stream(), "device", 60, "e").count() == 0
    assert late.run_distinct(stream(), ["device"], "e").count() == 0 and late.run_rows(stream(), "e").count() == 0
