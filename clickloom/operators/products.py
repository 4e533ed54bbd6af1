"""Top clicked products per area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import concat_long_string, group_concat_distinct, json_field
from clickloom.operators.ranking import top_n_per_group

# Level of the seven regions (north, east, south, central, north-west, south-west China);
# every other area, the north-east among them, has the default level.
AREA_LEVELS = {
    "华北": "A level",
    "华东": "A level",
    "华南": "B level",
    "华中": "B level",
    "西北": "C level",
    "西南": "C level",
}
DEFAULT_LEVEL = "D level"


def click_with_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Add city name and area to clicks; clicks of unknown cities drop out.

    No hint: a city table under the broadcast limit is broadcast by Spark on its size statistics, a
    larger one is joined by shuffle with adaptive splitting of hot cities.
    """
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id").select(
        "city_id", "city_name", "area", "product_id"
    )


def _clicks_per_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """(city_id, product_id, n, city_name, area): counted before the join, which sees one row per pair."""
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return per_city.join(cities.select("city_id", "city_name", "area"), "city_id")


def _city_infos() -> Column:
    return group_concat_distinct(concat_long_string(F.col("city_id"), F.col("city_name"), ":"))


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """(area, product_id, click_count, city_infos)."""
    return (
        _clicks_per_city(clicks, cities)
        .groupBy("area", "product_id")
        .agg(F.sum("n").alias("click_count"), _city_infos().alias("city_infos"))
    )


def product_status(extend_info: Column) -> Column:
    """``self`` when the JSON field ``product_status`` is 0, else ``third party``."""
    return F.when(json_field(extend_info, "product_status") == "0", "self").otherwise("third party")


def area_product_enriched(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Add product name and status; counts of unknown products drop out."""
    named = products.select(
        "product_id",
        "product_name",
        product_status(F.col("extend_info")).alias("product_status"),
    )
    return counts.join(named, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_level(
    area: Column, levels: Mapping[str, str] = AREA_LEVELS, default: str = DEFAULT_LEVEL
) -> Column:
    """Level of an area by name."""
    chain = None
    for name, level in levels.items():
        chain = F.when(area == name, level) if chain is None else chain.when(area == name, level)
    return F.lit(default) if chain is None else chain.otherwise(default)


def area_top_products(
    clicks: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = 3,
    levels: Mapping[str, str] = AREA_LEVELS,
    default: str = DEFAULT_LEVEL,
) -> DataFrame:
    """The ``n`` most clicked known products of every area; ties go to the lower product id.

    Ranked on counts alone; city lists, names and JSON status are made for the ranked products only.
    """
    placed = _clicks_per_city(clicks, cities)
    known = placed.join(products.select("product_id"), "product_id", "left_semi")
    ranked = top_n_per_group(
        known.groupBy("area", "product_id").agg(F.sum("n").alias("click_count")),
        by=["area"],
        order=[F.desc("click_count"), F.asc("product_id")],
        n=n,
        salt_on=["product_id"],
    )
    # Areas and counts are compared null-safe: a city without area is a group like any other.
    top = ranked.select(F.col("area").alias("_area"), F.col("product_id").alias("_product"), "click_count")
    same = F.col("area").eqNullSafe(F.col("_area")) & (F.col("product_id") == F.col("_product"))
    counts = (
        placed.join(top, same)
        .groupBy("area", "product_id", "click_count")
        .agg(_city_infos().alias("city_infos"))
    )
    return area_product_enriched(counts, products).select(
        "area",
        area_level(F.col("area"), levels, default).alias("area_level"),
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        "product_status",
    )
