"""The bucket functions under SQL, as inlined SQL expressions."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KINDS = {"": "TIMESTAMP_NTZ", "_tz": "TIMESTAMP"}


def register(spark: SparkSession) -> None:
    """Temporary functions for ``spark.sql``; Catalyst inlines them, nothing runs in Python.

    ``time_bucket(width, ts [, origin])`` takes zone-less instants, ``time_bucket_tz``
    zoned ones; ``time_bucket_months(n, ts)`` covers month widths.
    """
    for suffix, kind in _KINDS.items():
        origin = f"{kind} '2000-01-03 00:00:00'"
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION time_bucket{suffix}(
                  width INTERVAL DAY TO SECOND, at {kind}, origin {kind} DEFAULT {origin})
                RETURNS {kind}
                RETURN timestampadd(MICROSECOND,
                  -pmod(timestampdiff(MICROSECOND, origin, at),
                        timestampdiff(MICROSECOND, origin, origin + width)), at)"""
        )
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION time_bucket_months{suffix}(n INT, at {kind})
                RETURNS {kind}
                RETURN CAST(add_months(trunc(at, 'month'),
                  -pmod(year(at) * 12 + month(at) - 24001, n)) AS {kind})"""
        )
