from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import products
from clickloom.params import TaskParams
from clickloom.plans import ProductAnalysis
from tests.rows import action, actions


def tables(spark):
    cities = spark.createDataFrame(
        [(1, "x", "华北"), (11, "x", "华北"), (2, "y", "东北")],
        "city_id bigint, city_name string, area string",
    )
    goods = spark.createDataFrame(
        [(p, f"p{p}", s) for p, s in [(1, '{"product_status": 0}'), (2, '{"product_status": 1}'),
                                      (3, "{}"), (4, None)]],
        "product_id bigint, product_name string, extend_info string",
    )
    return cities, goods


def clicks(spark, pairs):
    return spark.createDataFrame(pairs, "city_id bigint, product_id bigint")


def test_counts_and_distinct_city_list(spark):
    cities, _ = tables(spark)
    got = products.area_product_clicks(
        clicks(spark, [(11, 1), (1, 1), (11, 1), (2, 1), (99, 1)]), cities
    ).collect()
    assert {(r.area, r.click_count, r.city_infos) for r in got} == {
        ("华北", 3, "11:x,1:x"),
        ("东北", 1, "2:y"),
    }


def test_status(spark):
    _, goods = tables(spark)
    got = goods.select("product_id", products.product_status(F.col("extend_info"))).collect()
    assert dict(tuple(r) for r in got) == {
        1: "self",
        2: "third party",
        3: "third party",
        4: "third party",
    }


def test_levels(spark):
    names = ["华北", "华东", "华南", "华中", "西北", "西南", "东北", "elsewhere"]
    df = spark.createDataFrame([(n,) for n in names], "area string")
    got = [r[0][0] for r in df.coalesce(1).select(products.area_level(F.col("area"))).collect()]
    assert got == list("AABBCCDD")
    assert df.select(products.area_level(F.col("area"), {}, "none")).distinct().first()[0] == "none"


def test_job_ties_and_unknown_products(spark):
    cities, goods = tables(spark)
    rows = [action(click_product_id=p, city_id=1) for p in (4, 3, 2, 2, 1, 77, 77, 77)]
    rows += [action(click_product_id=1, city_id=2), action(city_id=2), action(city_id=2, date="2023-01-01")]
    job = ProductAnalysis(
        actions(spark, rows), cities, goods, TaskParams("2024-03-01", "2024-03-01"), 8
    )
    got = job.top_products().collect()
    assert {(r.taskid, r.area, r.area_level, r.product_id, r.click_count) for r in got} == {
        (8, "华北", "A level", 2, 2),
        (8, "华北", "A level", 1, 1),
        (8, "华北", "A level", 3, 1),
        (8, "东北", "D level", 1, 1),
    }
