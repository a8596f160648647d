"""Questions answered from the sides of the wide table equal those asked over the wide table."""

import random

import pytest

from lodeworks.plans import marts


def _frames(spark, seed):
    r = random.Random(seed)
    mines = ["001", "002", "003", "004", "005"]
    orders = [
        (f"v{i % 190}", f"2024-0{r.randrange(1, 5)}-1{r.randrange(10)}", r.choice([None, *map(str, range(1, 25))]), r.choice([None, r.randrange(10**7) / 1000, 0.005, 12.345]), r.choice([None, *[f"D{m}" for m in mines]]))
        for i in range(200)
    ]
    customers = [(f"{k:010d}" if k % 2 else str(k), r.choice([None, "A", "B", f"C{k}"])) for k in range(1, 20)]
    tags = [(r.choice([None, "M001", "M002", "M003", "M009"]), r.choice([None, "F1", "F2", "F3"]), r.choice([None, r.randrange(10**6) / 1000])) for _ in range(300)]
    tags += [("M004", "F1", None)]
    samples = [(r.choice([None, "M001", "M002", "M003"]), r.choice([None, r.randrange(40000) / 1000]), r.choice([None, r.randrange(9000) / 100])) for _ in range(60)] + [("M005", None, 5.0)]
    return (
        spark.createDataFrame(orders, "VBELN string, ERDAT string, KUNNR string, NETWR double, BZIRK string"),
        spark.createDataFrame(customers, "KUNNR string, NAME1 string"),
        spark.createDataFrame(tags, "mine string, face string, value double"),
        spark.createDataFrame(samples, "MINE_CODE string, AD double, QGR_AD double"),
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_answers_are_the_same(spark, seed):
    orders, customers, tags, samples = _frames(spark, seed)
    wide = marts.sales_production(orders, customers, tags, samples)
    pairs = [
        (marts.production_vs_sales(wide), marts.production_vs_sales_by_side(orders, tags)),
        (marts.quality_pricing(wide), marts.quality_pricing_by_side(orders, tags, samples)),
        (marts.safety_trend(wide), marts.safety_trend_by_side(orders, tags)),
        (marts.fulfillment(wide), marts.fulfillment_by_side(orders, customers, tags)),
    ]
    for over_wide, by_side in pairs:
        assert by_side.columns == over_wide.columns
        want = sorted(map(repr, map(tuple, over_wide.collect())))
        assert len(want) >= 3 and sorted(map(repr, map(tuple, by_side.collect()))) == want


def test_no_orders_no_answers(spark):
    orders, customers, tags, samples = _frames(spark, 4)
    none = orders.limit(0)
    assert marts.production_vs_sales_by_side(none, tags).count() == marts.safety_trend_by_side(none, tags).count() == 0
    assert marts.quality_pricing_by_side(orders, tags, samples.limit(0)).count() == marts.fulfillment_by_side(orders, customers.limit(0), tags).count() == 0
