"""Streaming jobs, each drained over the given files. Windows that the watermark has not closed are left
out, as the SQL twins say; late rows of closed ones are not."""

from pyspark.sql import functions as F

from lodeworks.operators import ordered
from lodeworks.queries.ordered import stamp
from lodeworks.queries.registry import query
from lodeworks.queries.relational import _LEVEL, _LIMITS
from lodeworks.queries.roles import ROLES, half, davg, sql
from lodeworks.session import work_path
from lodeworks.sources import partitions
from lodeworks.sources import tables as lake
from lodeworks.sources.files import since
from lodeworks.streaming import alarms, ingest, io, late, windows

_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def raw_points(t):
    columns = ROLES["points"][1]
    return io.stream_table(t.spark, t.sf_dir, "events").selectExpr(*[f"{e} AS `{a}`" for a, e in columns.items()])


def point_stream(t):
    return io.event_time(raw_points(t))


def timed_points(t):
    """Without a watermark: these jobs keep their own."""
    return raw_points(t).withColumn("ts", F.col("ts").cast("timestamp"))


@query("st_source", sql("points", "SELECT event_id, point, value FROM points"))
def st_source(t):
    return io.run_append(point_stream(t).select("event_id", "point", "value"), "source")


@query(
    "st_alarm",
    sql("points", f"SELECT event_id, point, value, CAST({_LEVEL} AS INTEGER) AS level FROM points LEFT JOIN limits USING (point)", limits=_LIMITS),
)
def st_alarm(t):
    return io.run_append(alarms.alarm_level(point_stream(t)).select("event_id", "point", "value", "level"), "alarm")


@query("st_threshold_gas", sql("points", "SELECT event_id, value FROM points WHERE point = 'CH4_001_LEVEL' AND value > 100"))
def st_threshold_gas(t):
    return io.run_append(alarms.gas_alarms(point_stream(t), "CH4_001_LEVEL", 100.0).select("event_id", "value"), "gas")


@query("st_order", sql("points", "SELECT event_id, device, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM points"))
def st_order(t):
    path = work_path(t.spark, "ordered")
    rows = point_stream(t).select("event_id", "device", "ts")
    # The batch number in the path makes a repeated batch replace itself.
    io.run_batches(
        rows, "order", lambda b, no: windows.in_time_order(b, "device").write.mode("overwrite").parquet(f"{path}/batch={no}")
    )
    return t.spark.read.parquet(path).select("event_id", "device", stamp("ts").alias("ts"))


def _window_sql(size: str, slide: str) -> str:
    return (
        "SELECT point, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, "
        f"{half(davg('value'), 4)} AS avg_value, min(value) AS min_value, max(value) AS max_value FROM "
        f"(SELECT point, value, ts, unnest(generate_series(time_bucket(INTERVAL {slide}, ts) - INTERVAL {size} + INTERVAL {slide}, "
        f"time_bucket(INTERVAL {slide}, ts), INTERVAL {slide})) AS s FROM points) "
        f"WHERE s + INTERVAL {size} <= {_CLOSED} GROUP BY point, s"
    )


def _shown(out):
    return out.select("point", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "avg_value", "min_value", "max_value")


@query("st_tumbling", sql("points", _window_sql("8 HOUR", "8 HOUR")))
def st_tumbling(t):
    return _shown(late.run_aggregates(timed_points(t), "point", "8 hours", "tumbling"))


@query("st_preagg", sql("points", _window_sql("2 HOUR", "1 HOUR")))
def st_preagg(t):
    return _shown(late.run_aggregates(timed_points(t), "point", "2 hours", "sliding", slide="1 hour"))


@query(
    "st_sigma",
    sql(
        "points",
        "SELECT e.event_id, e.point, e.value FROM ev e JOIN (SELECT p.point, p.e, avg(w.value) AS mean, stddev_samp(w.value) AS sigma "
        "FROM (SELECT DISTINCT point, e FROM ev) p JOIN points w ON w.point = p.point AND w.ts >= p.e - INTERVAL 24 HOUR AND w.ts < p.e "
        f"WHERE p.e <= {_CLOSED} GROUP BY p.point, p.e) s ON e.point = s.point AND e.e = s.e WHERE abs(e.value - mean) > 3 * sigma",
        ev="SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS e FROM points",
    ),
)
def st_sigma(t):
    stats = late.run_stats(timed_points(t), "point", "24 hours", "6 hours", "sigma-stats")
    hits = windows.sigma_alerts(point_stream(t), stats, "point", "6 hours")
    return io.run_append(hits.select("event_id", "point", "value"), "sigma")


@query(
    "st_debounce",
    sql(
        "points",
        "SELECT device, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (SELECT *, lag(ts, 2) OVER (PARTITION BY device ORDER BY ts, event_id) AS ts2 "
        "FROM (SELECT *, lag(state) OVER (PARTITION BY device ORDER BY ts, event_id) AS prev FROM points) WHERE prev IS NOT NULL AND prev <> state) "
        "WHERE ts - ts2 <= INTERVAL 6 HOUR",
    ),
)
def st_debounce(t):
    rows = late.run_rows(timed_points(t).select("device", "state", "event_id", "ts"), "debounce")
    found = ordered.glitches(rows, "device", "state", ["ts", "event_id"], changes=3, within_seconds=6 * 3600)
    return found.select("device", "event_id", stamp("ts").alias("ts"))


@query(
    "st_heartbeat",
    sql(
        "points",
        "SELECT device, strftime(ts + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS offline_at FROM "
        "(SELECT device, ts, lead(ts) OVER (PARTITION BY device ORDER BY ts) AS nxt FROM points) "
        f"WHERE nxt - ts > INTERVAL 24 HOUR OR (nxt IS NULL AND ts + INTERVAL 24 HOUR < {_CLOSED})",
    ),
)
def st_heartbeat(t):
    marks = late.run_heartbeat(timed_points(t), "device", 24 * 3600, "heartbeat")
    return marks.select("device", stamp("offline_at").alias("offline_at"))


@query(
    "st_session",
    sql(
        "points",
        "SELECT device, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS online_from, strftime(max(ts) + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS offline_at, count(*) AS n FROM "
        "(SELECT *, sum(is_new) OVER (PARTITION BY device ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY device ORDER BY ts, event_id) "
        "<= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS is_new FROM points)) GROUP BY device, s",
    ),
)
def st_session(t):
    """The batch twin of the heartbeat: online sessions per device."""
    events = t.points.withColumn("ts", F.col("ts").cast("timestamp"))
    sessions = events.groupBy("device", F.session_window("ts", "12 hours")).agg(F.count(F.lit(1)).alias("n"))
    return sessions.select(
        "device", stamp("session_window.start").alias("online_from"), stamp("session_window.end").alias("offline_at"), "n"
    )


@query("st_dedup", sql("points", "SELECT DISTINCT event_id, point, value FROM points"))
def st_dedup(t):
    replayed = timed_points(t).unionByName(timed_points(t))
    return late.run_distinct(replayed, ["event_id"], "dedup").select("event_id", "point", "value")


@query("st_incr_append", "SELECT o_orderkey, o_totalprice, 'sap_erp' AS source_system FROM orders")
def st_incr_append(t):
    orders = io.stream_table(t.spark, t.sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ingest.append_increments(orders, "sap_erp").drop("etl_time")


@query(
    "st_incr_upsert",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def st_incr_upsert(t):
    path = work_path(t.spark, "customer-state")
    orders = io.stream_table(t.spark, t.sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    ingest.upsert_buckets(orders, path, ["o_custkey"], ["o_orderkey"], buckets=16)
    return partitions.read_buckets(t.spark, path)


@query("st_incr_overwrite", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def st_incr_overwrite(t):
    path = work_path(t.spark, "master")
    lake.commit(t.customer.select("c_custkey", F.lit("old").alias("c_name"), "c_mktsegment"), path)
    customers = io.stream_table(t.spark, t.sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    ingest.overwrite_increments(customers, path)
    return lake.read_version(t.spark, path)


@query("st_since", "SELECT o_orderkey, o_totalprice FROM orders")
def st_since(t):
    """Two runs on one checkpoint: the second finds nothing new, so each row is taken once."""
    path, checkpoint = work_path(t.spark, "since"), work_path(t.spark, "since-checkpoint")
    for _ in range(2):
        orders = io.stream_table(t.spark, t.sf_dir, "orders").select("o_orderkey", "o_totalprice")
        taken = ingest.append_increments(orders, "sap_erp", path, checkpoint)
    return taken.select("o_orderkey", "o_totalprice")


@query("st_since_batch", "SELECT event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def st_since_batch(t):
    mark = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return since(t.events, "ts", mark).select("event_id", "value")
