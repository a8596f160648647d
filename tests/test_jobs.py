"""The command line jobs on a small raw folder laid out as the source systems deliver it."""

import numpy as np
import pandas as pd
import pytest

from lodeworks import jobs
from lodeworks.operators import catalog
from lodeworks.plans import layers
from lodeworks.sources import files, reports
from lodeworks.sources import tables as lake
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for system in ("sap_erp", "pi_system", "lims", "oa"):
        (root / system).mkdir()

    def orders(year, keys):
        return pd.DataFrame(
            {
                "VBELN": keys,
                "ERDAT": f"{year}-03-01",
                "ERNAM": "USER",
                "KUNNR": ["102847", "102848"] * (len(keys) // 2),
                "NETWR": [100.0, np.nan] + [50.0 + i for i in range(len(keys) - 2)],
                "AUART": "OR",
                "VKORG": "CN01",
                "BZIRK": "D001",
            }
        )

    orders(2022, ["1", "2", "3", "3"]).to_parquet(root / "sap_erp/vbak_year=2022.parquet")
    orders(2023, ["4", "5", "6", "1"]).assign(IHREZ="x").to_parquet(root / "sap_erp/vbak_year=2023.parquet")
    lines = pd.DataFrame({"VBELN": ["1", "4", "0000000000"], "POSNR": "10", "MATNR": ["501010001", "501010002", None], "NETWR": [5.0, 6.0, 7.0]})
    lines.to_parquet(root / "sap_erp/vbap_year=2022.parquet")
    pd.DataFrame({"KUNNR": ["102847", "102848"], "NAME1": ["A", "B"], "ORT01": "X", "STCD1": "91410000123456"}).to_parquet(root / "sap_erp/kna1.parquet")
    tags = pd.DataFrame(
        {"tag": "M001_FACE_A_WAGAS", "timestamp": "2022-01-01 00:00:00", "value": [0.1, 0.2, 99999.0, 0.3], "status": [0, 0, 0, -1], "mine": "M001", "face": "FACE_A"}
    )
    tags.to_parquet(root / "pi_system/tags_year=2022_month=01.parquet")
    tags.to_parquet(root / "pi_system/tags_year=2022_month=02.parquet")
    samples = pd.DataFrame(
        {
            "SAMPLE_ID": ["LM1", "LM2"],
            "MINE_CODE": "M001",
            "MINE_NAME": "矿",
            "SAMPLE_TYPE": "原煤",
            "SAMPLING_DATE": "2022-01-05",
            "TEST_LAB": "L",
            "AD": [20.0, 30.0],
            "VD": 1.0,
            "QGR_AD": 20.0,
            "全硫St": 0.5,
        }
    )
    samples.to_parquet(root / "lims/samples_year=2022.parquet")
    flow = pd.DataFrame({"FLOW_ID": ["f", "g"], "FLOW_TYPE": "付款申请", "INITIATOR": "u", "APPLY_DATE": "2022-01-01", "AMOUNT": [1.0, np.nan]})
    flow.to_parquet(root / "oa/doc_flow_year=2022.parquet")
    return str(root)


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return root, {r.table_name: r for r in jobs.ingest(spark, raw, root).collect()}


def test_all_files_are_landed_and_cleaned(spark, built):
    root, stats = built
    # Eight orders of two years: two lack a price, one number repeats inside 2022, one across the years.
    assert (stats["sales/dwd_vbak"].before, stats["sales/dwd_vbak"].after) == (8, 4)
    assert (stats["production/dwd_tags"].before, stats["production/dwd_tags"].after) == (8, 4)
    orders = lake.read_version(spark, layers.table_path(root, "dwd", "sales/dwd_vbak"))
    assert {r.VBELN: (r.year, r.NETWR) for r in orders.collect()} == {"1": (2022, 100.0), "3": (2022, 50.0), "4": (2023, 100.0), "6": (2023, 50.0)}
    assert not set(files.POSITION) & set(orders.columns) and "IHREZ" in orders.columns


def test_marts_dimensions_and_wide_table(spark, built):
    root, _ = built
    daily = lake.read_version(spark, layers.table_path(root, "dwa", "sales/dwa_sales_daily"))
    assert {r.sale_date: (r.order_count, r.total_amount) for r in daily.collect()} == {"2022-03-01": (2, 150.0), "2023-03-01": (2, 150.0)}
    alarm = lake.read_version(spark, layers.table_path(root, "dwa", "production/dwa_tag_alarm")).first()
    assert (alarm.total_records, alarm.missing_count, alarm.high_value_count) == (8, 2, 2)
    assert jobs.build_dimensions(spark, root) == ["mine", "customer", "material", "coal_type"]
    customer = lake.read_version(spark, layers.table_path(root, "dwd", "_dimensions/dim_customer"))
    assert {r.kunnr for r in customer.collect()} == {"0000102847", "0000102848"}
    jobs.build_wide(spark, root)
    row = jobs.scenario(spark, root, "production_sales").first()
    assert (row.mine_code, row.order_count, row.avg_order_amount) == ("M001", 4, 75.0)
    names = {r.customer_name for r in jobs.scenario(spark, root, "order_fulfillment").collect()}
    assert names == {"A"}  # both keys padded alike, so the join matches


def test_quality_run_replaces_scores_of_the_day(spark, raw, tmp_path):
    out = str(tmp_path / "quality")
    first = {r.table_name: r for r in jobs.run_quality(spark, raw, out, run_date="2026-07-14").collect()}
    assert len(first) == 6 and (first["kna1"].passed, first["kna1"].failed, first["kna1"].grade) == (4, 1, "B")
    assert first["tags"].score == 60.0 and all(r.duration_s > 0 for r in first.values())
    jobs.run_quality(spark, raw, out, "pi_system", "2026-07-14")
    jobs.run_quality(spark, raw, out, "oa", "2026-07-15")
    history = jobs.score_history(spark, out)
    assert history.count() == 7
    assert history.where("run_date = '2026-07-14' AND table_name = 'tags'").count() == 1
    assert spark.read.json(f"{out}/alerts").where("table_name = 'tags'").count() == 2
    report = reports.read_report(spark, f"{out}/reports/pi_system__tags").first()
    assert {d.column_name for d in report.details} == {"status", "value"}


def test_quality_run_skips_a_missing_table(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.run_quality(spark, str(tmp_path), str(tmp_path / "q"))


def test_subject_copy_dry_run(spark, tmp_path):
    root = str(tmp_path)
    for key in ("sap_erp/dwd_vbak", "sap_erp/dwd_vbap", "sap_erp/dwd_kna1", "pi_system/dwd_tags", "lims/dwd_samples", "oa/dwd_doc_flow"):
        spark.range(3).write.parquet(f"{root}/dwd/{key}")
    assert {r.written_rows for r in jobs.copy_subjects(spark, root, dry_run=True).collect()} == {0}
    assert {r.target: r.written_rows for r in jobs.copy_subjects(spark, root).collect()}["finance/dwd_doc_flow"] == 3


def test_glossary(spark):
    schema = "table_name string, column_name string, cn_name string, business_terms array<string>, value_mappings map<string,string>"
    glossary = spark.createDataFrame(
        [("vbak", "AUART", "销售凭证类型", ["订单类型", "凭证类型"], {"OR": "标准订单", "RET": "退货单"}), ("vbak", "X", "x", [], None)], schema
    )
    assert {r.term for r in catalog.glossary_terms(glossary).collect()} == {"订单类型", "凭证类型", None}
    df = spark.createDataFrame([("OR",), ("ZZZ",)], "AUART string")
    assert {r.AUART: r.label for r in catalog.decode(df, glossary, "vbak", "AUART", "label").collect()} == {"OR": "标准订单", "ZZZ": None}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame(pd.DataFrame({"v": [1.0, np.nan]})).withColumn("v", F.coalesce("v", F.lit(float("nan"))))
    assert files.nan_to_null(df).where("v IS NULL").count() == 1
