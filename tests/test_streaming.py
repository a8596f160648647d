"""State must survive batch borders: the same events in one file and in many must give the same."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks.session import work_path
from lodeworks.sources import tables as lake
from lodeworks.streaming import alarms, ingest, io, stateful, windows


def _events(n=400, seed=5):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.integers(0, 36_000, n))
    return pd.DataFrame(
        {
            "event_id": np.arange(n),
            "ts": (np.datetime64("2024-01-01") + t.astype("timedelta64[s]")).astype("datetime64[us]"),
            "device": np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b"], n)),
            "state": rng.choice(["on", "off"], n),
            "value": rng.normal(10, 1, n),
        }
    )


def _stream(spark, tmp_path, pdf, parts):
    folder = tmp_path / f"parts{parts}"
    folder.mkdir()
    for i, chunk in enumerate(np.array_split(np.arange(len(pdf)), parts)):
        pdf.iloc[chunk].to_parquet(folder / f"{i:03d}.parquet", coerce_timestamps="us")
    # Files are taken in order of their modification time; one per batch.
    schema = spark.read.parquet(str(folder)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return io.event_time(stream)


def _glitches(pdf, seconds):
    out = []
    for _, part in pdf.sort_values(["ts", "event_id"]).groupby("device"):
        moved = part[(part["state"] != part["state"].shift(1)) & part["state"].shift(1).notna()]
        out += moved.loc[(moved["ts"] - moved["ts"].shift(2)).dt.total_seconds() <= seconds, "event_id"].tolist()
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 6])
def test_debounce(spark, tmp_path, parts):
    pdf = _events()
    got = io.run_append(stateful.debounce(_stream(spark, tmp_path, pdf, parts), 3, 120), "debounce")
    want = _glitches(pdf, 120)
    assert want and sorted(r.event_id for r in got.collect()) == want


@pytest.mark.parametrize("parts", [1, 6])
def test_heartbeat(spark, tmp_path, parts):
    pdf = _events()
    got = io.run_append(stateful.heartbeat(_stream(spark, tmp_path, pdf, parts), 300), "heartbeat").toPandas()
    watermark = pdf["ts"].max() - pd.Timedelta("10min")
    want = []
    for device, part in pdf.groupby("device"):
        ts = part["ts"].sort_values()
        silent = ts[(ts.shift(-1) - ts).dt.total_seconds() > 300] + pd.Timedelta("300s")
        want += [(device, x) for x in silent]
        if ts.max() + pd.Timedelta("300s") < watermark:
            want.append((device, ts.max() + pd.Timedelta("300s")))
    assert want and sorted(zip(got["device"], got["offline_at"], strict=True)) == sorted(want)
    assert got["value"].isna().all()


@pytest.mark.parametrize("parts", [1, 5])
def test_tumbling_leaves_open_windows_out(spark, tmp_path, parts):
    pdf = _events()
    got = io.run_append(windows.windowed(_stream(spark, tmp_path, pdf, parts), "device", "1 hour"), "tumbling").toPandas()
    closed = pdf["ts"].max() - pd.Timedelta("10min")
    start = pdf["ts"].dt.floor("h")
    want = pdf.assign(w=start)[start + pd.Timedelta("1h") <= closed].groupby(["device", "w"]).size()
    assert dict(zip(zip(got["device"], got["window_start"], strict=True), got["n"], strict=True)) == want.to_dict()


def test_replays_are_dropped(spark, tmp_path):
    pdf = _events(100)
    twice = pd.concat([pdf, pdf], ignore_index=True)
    got = io.run_append(windows.without_replays(_stream(spark, tmp_path, twice, 1), ["event_id"]).select("event_id"), "dedup")
    assert sorted(r.event_id for r in got.collect()) == list(range(100))


def test_alarm_levels(spark):
    rows = [("FAN_001_TEMP", 69.9), ("FAN_001_TEMP", 70.0), ("FAN_001_TEMP", 84.0), ("MINER_001_SPEED", 1e9), ("UNKNOWN", 5.0), ("FAN_001_TEMP", None)]
    df = spark.createDataFrame(rows, "point string, value double")
    got = sorted((r.point, r.value if r.value is not None else -1.0, r.level) for r in alarms.alarm_level(df).collect())
    assert got == [("FAN_001_TEMP", -1.0, 0), ("FAN_001_TEMP", 69.9, 0), ("FAN_001_TEMP", 70.0, 1), ("FAN_001_TEMP", 84.0, 2), ("MINER_001_SPEED", 1e9, 0), ("UNKNOWN", 5.0, 0)]


def test_sigma_alert_uses_the_window_before(spark):
    base = pd.Timestamp("2024-01-01")
    calm = pd.DataFrame({"point": "p", "ts": [base + pd.Timedelta(minutes=i) for i in range(60)], "value": [1.0, 2.0] * 30})
    spike = pd.DataFrame({"point": "p", "ts": [base + pd.Timedelta(minutes=75)], "value": [50.0]})
    df = spark.createDataFrame(pd.concat([calm, spike])).withColumn("ts", F.col("ts").cast("timestamp"))
    stats = windows.window_stats(df, "point", "1 hour", "1 hour")
    assert [r.value for r in windows.sigma_alerts(df, stats, "point", "1 hour").collect()] == [50.0]


def test_upsert_stream_over_several_batches(spark, tmp_path):
    pdf = pd.DataFrame({"k": [1, 2, 1, 3, 1, 2], "seq": [1, 1, 2, 1, 3, 2], "v": list("abcdef")})
    folder = tmp_path / "inc"
    folder.mkdir()
    for i in range(3):
        pdf.iloc[2 * i : 2 * i + 2].to_parquet(folder / f"{i}.parquet")
    stream = spark.readStream.schema(spark.read.parquet(str(folder)).schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    path = work_path(spark, "state")
    ingest.upsert_increments(stream, path, ["k"], ["seq"])
    assert {r.k: r.v for r in lake.read_version(spark, path).collect()} == {1: "e", 2: "f", 3: "d"}
    assert lake.latest_version(spark, path) == 2


def test_a_directory_table_streams_all_its_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert io.run_append(io.stream_table(spark, str(tmp_path), "events", 1), "folder").count() == 1000


def test_a_delivery_in_several_batches_stays_whole(spark, tmp_path):
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "master.parquet"))
    path = work_path(spark, "delivered")
    lake.commit(spark.range(5), path)
    ingest.overwrite_increments(io.stream_table(spark, str(tmp_path), "master", 1), path)
    assert sorted(r.id for r in lake.read_version(spark, path).collect()) == list(range(30))
