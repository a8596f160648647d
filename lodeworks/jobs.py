"""Command line of the lakehouse.

    python -m lodeworks.jobs ingest     --raw DIR --lake DIR [--layer ods|dwd|dwa|all]
    python -m lodeworks.jobs dimensions --lake DIR [--dimension mine|customer|material|coal_type|all]
    python -m lodeworks.jobs subjects   --lake DIR [--dry-run]
    python -m lodeworks.jobs wide       --lake DIR [--sample P]
    python -m lodeworks.jobs scenario   --lake DIR NAME
    python -m lodeworks.jobs quality    --raw DIR --out DIR [--system NAME] [--run-date DATE]
    python -m lodeworks.jobs history    --out DIR [--days N]

``--raw`` holds ``{system}/{table}.parquet`` or ``{system}/{table}_year=*.parquet``.
"""

from __future__ import annotations

import argparse
import sys
import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks import constants as c
from lodeworks.functions import in_sample
from lodeworks.operators import dimensions, quality, rules
from lodeworks.plans import layers, marts
from lodeworks.session import build_session, work_path
from lodeworks.sources import files, reports
from lodeworks.sources import tables as lake

HISTORY_SCHEMA = (
    "system string, table_name string, score double, grade string, passed bigint, failed bigint, duration_s double, run_date date"
)
SCENARIOS = {
    "production_sales": lambda w: marts.production_vs_sales(w).orderBy(F.desc("avg_production"), "mine_code"),
    "coal_pricing": lambda w: marts.quality_pricing(w).orderBy(F.desc("avg_calorific"), "mine_code"),
    "safety_trend": lambda w: marts.safety_trend(w).orderBy(F.desc("stddev_value"), "mine_code", "face"),
    "order_fulfillment": lambda w: marts.fulfillment(w).orderBy(F.desc("total_amount"), "customer_name").limit(20),
}


def raw_table(spark: SparkSession, root: str, key: str) -> DataFrame:
    """One table: its own file or folder, or its yearly parts, and nothing whose name only starts alike."""
    return files.read_raw(spark, f"{root}/{key}{{,_year=*}}.parquet")


def ingest(spark: SparkSession, raw: str, root: str, layer: str = "all") -> DataFrame:
    sources = {key: raw_table(spark, raw, key) for key in layers.DWD_SOURCES.values()} if layer in ("ods", "all") else {}
    order = {name: files.POSITION for name in ("vbak", "vbap")}
    return layers.run(spark, root, sources, order, layer)


def build_dimensions(spark: SparkSession, root: str, which: str = "all") -> list[str]:
    def dwd(key: str) -> DataFrame:
        return lake.read_version(spark, layers.table_path(root, "dwd", key))

    makers = {
        "mine": lambda: dimensions.dim_mine(dwd("production/dwd_tags"), dwd("coal_quality/dwd_samples")),
        "customer": lambda: dimensions.dim_customer(dwd("sales/dwd_kna1")),
        "material": lambda: dimensions.dim_material(dwd("sales/dwd_vbap")),
        "coal_type": lambda: dimensions.dim_coal_type(dwd("coal_quality/dwd_samples")),
    }
    names = list(makers) if which == "all" else [which]
    for name in names:
        lake.commit(makers[name](), layers.table_path(root, "dwd", f"_dimensions/dim_{name}"))
    return names


def copy_subjects(spark: SparkSession, root: str, dry_run: bool = False) -> DataFrame:
    """Copy system-partitioned cleaned tables (as older runs left them) to their subject paths."""
    base = layers.table_path(root, "dwd", "")
    tables = {key: lake.read_table(spark, base + key, fallback=base + key) for key in c.SUBJECT_PATHS}
    return lake.copy_by_subject(tables, c.SUBJECT_PATHS, base.rstrip("/"), dry_run)


def build_wide(spark: SparkSession, root: str, sample: float = 1.0) -> int:
    """The cross-system wide table over all orders, or over a reproducible share of them."""

    def dwd(key: str) -> DataFrame:
        return lake.read_version(spark, layers.table_path(root, "dwd", key))

    orders = dwd("sales/dwd_vbak")
    if sample < 1.0:
        orders = orders.where(in_sample("VBELN", sample))
    wide = marts.sales_production(orders, dwd("sales/dwd_kna1"), dwd("production/dwd_tags"), dwd("coal_quality/dwd_samples"))
    return lake.commit(wide, layers.table_path(root, "dwa", "dwa_sales_production"))


def scenario(spark: SparkSession, root: str, name: str) -> DataFrame:
    wide = lake.read_version(spark, layers.table_path(root, "dwa", "dwa_sales_production"))
    return SCENARIOS[name](wide)


def run_checkpoint(df: DataFrame, system: str, table: str, out: str) -> DataFrame:
    """Check one table, write its report, and return the score row with the time it took."""
    spark, start = df.sparkSession, time.perf_counter()
    results = rules.checkpoint({(system, table): df})
    path = work_path(spark, "results")
    results.write.parquet(path)
    results = spark.read.schema(results.schema).parquet(path)
    scores = rules.scored(results, ["system", "table_name"])
    reports.write_report(reports.build_report(results, scores), f"{out}/reports/{system}__{table}")
    return scores.withColumn("duration_s", F.lit(round(time.perf_counter() - start, 3)))


def run_quality(spark: SparkSession, raw: str, out: str, system: str = "all", run_date: str | None = None) -> DataFrame:
    """Check every table of the systems, record the scores under the run date, append alerts.

    Scores of the same date, system and table are replaced. A table that cannot be read or checked
    is reported and skipped.
    """
    day = F.lit(run_date or date.today().isoformat()).cast("date")
    batch = None
    for key_system, table in c.QUALITY_RULES:
        if system not in ("all", key_system):
            continue
        try:
            row = run_checkpoint(raw_table(spark, raw, f"{key_system}/{table}"), key_system, table, out)
        except Exception as error:  # noqa: BLE001 - one bad table must not stop the run
            print(f"skipped {key_system}.{table}: {error}", file=sys.stderr)
            continue
        batch = row if batch is None else batch.unionByName(row)
    if batch is None:
        raise FileNotFoundError(f"nothing to check under {raw}")
    # The merged rows are written aside first: the history partition they come from is overwritten.
    staged = work_path(spark, "scores")
    merged = quality.merge_history(score_history(spark, out).where(F.col("run_date") == day), batch.withColumn("run_date", day))
    merged.write.parquet(staged)
    fresh = spark.read.parquet(staged)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(f"{out}/scores")
    alerts = quality.alerts_below(fresh).select(F.current_timestamp().alias("timestamp"), "system", "table_name", "score", "grade")
    alerts.write.mode("append").json(f"{out}/alerts")
    return fresh


def score_history(spark: SparkSession, out: str) -> DataFrame:
    if not lake.exists(spark, f"{out}/scores"):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).parquet(f"{out}/scores")


def preview(df: DataFrame, out: str | None) -> None:
    """Write the whole result if a folder is given, and show its first rows."""
    if out:
        df.write.mode("overwrite").parquet(out)
        df = df.sparkSession.read.parquet(out)
    print(f"first 20 rows{f' of {out}' if out else '; --out or --to writes all of them'}")
    df.show(20, truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lodeworks", description="Lakehouse jobs")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *flags: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for flag in flags:
            sub.add_argument(f"--{flag}", required=True)
        sub.add_argument("--work", help="shared folder for intermediate results (spark.checkpoint.dir)")
        return sub

    command("ingest", "raw", "lake").add_argument("--layer", default="all", choices=["ods", "dwd", "dwa", "all"])
    command("dimensions", "lake").add_argument(
        "--dimension", default="all", choices=["mine", "customer", "material", "coal_type", "all"]
    )
    command("subjects", "lake").add_argument("--dry-run", action="store_true")
    command("wide", "lake").add_argument("--sample", type=float, default=1.0)
    answers = command("scenario", "lake")
    answers.add_argument("name", choices=list(SCENARIOS))
    answers.add_argument("--out", help="folder for the whole result")
    checks = command("quality", "raw", "out")
    checks.add_argument("--system", default="all", choices=["all", *sorted({s for s, _ in c.QUALITY_RULES})])
    checks.add_argument("--run-date")
    past = command("history", "out")
    past.add_argument("--days", type=int, default=30)
    past.add_argument("--to", help="folder for the whole result")
    args = parser.parse_args(argv)
    if args.command == "wide" and not 0 < args.sample <= 1:
        parser.error(f"--sample must be in (0, 1], got {args.sample}")

    spark = build_session(f"lodeworks-{args.command}", **({"spark.checkpoint.dir": args.work} if args.work else {}))
    if args.command == "ingest":
        ingest(spark, args.raw, args.lake, args.layer).show(truncate=False)
    elif args.command == "dimensions":
        print("built", build_dimensions(spark, args.lake, args.dimension))
    elif args.command == "subjects":
        copy_subjects(spark, args.lake, args.dry_run).show(truncate=False)
    elif args.command == "wide":
        print("version", build_wide(spark, args.lake, args.sample))
    elif args.command == "scenario":
        preview(scenario(spark, args.lake, args.name), args.out)
    elif args.command == "quality":
        run_quality(spark, args.raw, args.out, args.system, args.run_date).show(truncate=False)
    else:
        preview(quality.recent_history(score_history(spark, args.out), F.current_date(), args.days), args.to)


if __name__ == "__main__":
    main()
