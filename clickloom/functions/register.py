"""SQL names for the scalar functions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_functions(spark: SparkSession) -> None:
    """Create temporary SQL functions ``concat_long_string`` and ``json_field``.

    They are SQL expressions, so Catalyst inlines them. For the distinct concatenation write
    ``listagg(distinct x, ',') within group (order by x)``, a built-in.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(num BIGINT, txt STRING, sep STRING) "
        "RETURNS STRING "
        "RETURN concat(coalesce(cast(num AS STRING), 'null'), sep, coalesce(txt, 'null'))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_field(doc STRING, field STRING) "
        "RETURNS STRING RETURN get_json_object(doc, concat('$[\\'', field, '\\']'))"
    )
