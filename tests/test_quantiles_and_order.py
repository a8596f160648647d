import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodeworks.operators import ordered, quantiles


def _frame(seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    hot = pd.DataFrame({"k": "hot", "v": rng.lognormal(1, 2, 30_000).round(3)})
    flat = pd.DataFrame({"k": "flat", "v": np.repeat([1.0, 2.0], [10, 5000])})
    small = pd.DataFrame({"k": [f"s{i % 40}" for i in range(500)], "v": rng.normal(0, 5, 500)})
    one = pd.DataFrame({"k": ["one", "none", "z", "z", "z", "z"], "v": [3.5, None, 0.0, -1e-300, 1e300, -0.0]})
    return pd.concat([hot, flat, small, one], ignore_index=True)


@pytest.mark.parametrize("steps", [64, 1])
def test_quantiles_are_exact(spark, monkeypatch, steps):
    """With coarse buckets as well as fine ones."""
    monkeypatch.setattr(quantiles, "STEPS_PER_OCTAVE", steps)
    pdf = _frame()
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p995": 0.995, "p100": 1.0}
    got = quantiles.exact_quantiles(spark.createDataFrame(pdf).repartition(7), ["k"], "v", probs).toPandas().set_index("k")
    want = pdf.dropna().groupby("k")["v"].quantile(list(probs.values())).unstack()
    want.columns = list(probs)
    pd.testing.assert_frame_equal(got.sort_index(), want.sort_index(), check_names=False, rtol=1e-12)


def test_quantile_of_the_whole_table(spark):
    pdf = _frame()
    got = quantiles.exact_median(spark.createDataFrame(pdf), [], "v").first().median
    assert got == pytest.approx(pdf["v"].median())


def test_spikes_above_the_median(spark):
    df = spark.createDataFrame(pd.DataFrame({"v": [1.0] * 9 + [4.0, None]}))
    rows = quantiles.above_multiple_of_median(df, "v").toPandas()
    assert rows["is_spike"].sum() == 1 and len(rows) == 11


def _series(seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    n = 3000
    start = np.datetime64("2024-01-01")
    pdf = pd.DataFrame(
        {
            "tag": np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n)),
            "ts": start + rng.integers(0, 9 * 86400, n).astype("timedelta64[s]"),
            "id": range(n),
            "v": np.where(rng.random(n) < 0.3, np.nan, rng.normal(0, 1, n)),
        }
    )
    pdf.loc[(pdf["tag"] == "a") & (pdf["ts"] > "2024-01-03") & (pdf["ts"] < "2024-01-06"), "v"] = np.nan
    return pdf


def _spark(spark, pdf):
    df = spark.createDataFrame(pdf.assign(ts=pdf["ts"].astype("datetime64[us]")))
    return df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_previous_value_across_buckets(spark, unit):
    pdf = _series()
    got = ordered.with_previous(_spark(spark, pdf), ["tag"], ["ts", "id"], {"prev_id": "id"}, unit=unit).toPandas()
    ordered_pdf = pdf.sort_values(["tag", "ts", "id"])
    want = dict(zip(ordered_pdf["id"], ordered_pdf.groupby("tag")["id"].shift(1).fillna(-1), strict=True))
    assert dict(zip(got["id"], got["prev_id"].fillna(-1), strict=True)) == want


@pytest.mark.parametrize("unit", ["hour", "day"])
def test_gap_steps(spark, unit):
    pdf = _series()
    got = ordered.gap_steps(_spark(spark, pdf), ["tag"], "ts", 600, unit).toPandas().set_index("tag")
    for tag, part in pdf.groupby("tag"):
        step = part["ts"].sort_values().diff().dropna().dt.total_seconds()
        assert (got.loc[tag, "steps"], got.loc[tag, "gaps"]) == (len(step), (step > 600).sum())
        assert got.loc[tag, "longest_micros"] == step.max() * 1e6


def test_continuity_counts_repeated_times_once(spark):
    times = pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:00", "2024-01-01 03:00", "2024-01-02 01:00"])
    df = spark.createDataFrame(pd.DataFrame({"tag": "t", "ts": times.astype("datetime64[us]")}))
    row = ordered.continuity(df, ["tag"], "ts", "hour").first()
    assert (row.expected, row.actual, row.missing) == (26, 3, 23)
    assert ordered.missing_slots(df, ["tag"], "ts", "hour").count() == 23


@pytest.mark.parametrize("unit", ["hour", "day"])
def test_fill_gaps(spark, unit):
    pdf = _series()
    got = ordered.fill_gaps(_spark(spark, pdf), ["tag"], ["ts", "id"], "v", unit=unit).toPandas().set_index("id").sort_index()
    pdf = pdf.sort_values(["tag", "ts", "id"])
    fwd = pdf.groupby("tag")["v"].ffill()
    want = dict(zip(pdf["id"], fwd, strict=True))
    assert got["value_ffill"].equals(pd.Series(want).sort_index().rename_axis("id").rename("value_ffill"))
    for _, part in pdf.groupby("tag"):
        x = part["ts"].astype("int64").to_numpy()
        known = part["v"].notna().to_numpy()
        inside = (x >= x[known][0]) & (x <= x[known][-1])
        # np.interp has no rule for equal times; leave them out of the comparison.
        plain = inside & ~pd.Series(x).duplicated(keep=False).to_numpy()
        line = np.interp(x, x[known], part["v"].to_numpy()[known])
        np.testing.assert_allclose(got.loc[part["id"], "value_linear"].to_numpy()[plain], line[plain], rtol=1e-6, atol=1e-9)


def test_scd2(spark):
    rows = [("C", "2022-01-01", 1, "A"), ("C", "2022-02-01", 2, "A"), ("C", "2023-07-01", 3, "x"), ("C", "2023-07-01", 4, "B")]
    df = spark.createDataFrame(rows, "k string, d string, seq int, addr string").withColumn("d", F.col("d").cast("date"))
    got = [(r.addr, str(r.valid_from), str(r.valid_to)) for r in ordered.scd2(df, ["k"], "d", "addr", ["seq"]).orderBy("valid_from").collect()]
    assert got == [("A", "2022-01-01", "2023-06-30"), ("B", "2023-07-01", "9999-12-31")]
