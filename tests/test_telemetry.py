"""The lab's hourly telemetry is whole: every vehicle, every hour, every sensor."""

import __spark_entry__
from tidevault.sources.generate import SENSORS

SF_DIR = "/root/testdata/sf0.001"


def test_hourly_telemetry_has_all_vehicles_hours_and_sensors(spark):
    out = __spark_entry__.queries()["telemetry_hourly"](spark, SF_DIR)
    cars = spark.read.parquet(f"{SF_DIR}/customer.parquet").count()
    rows = out.collect()
    assert set(SENSORS) <= set(out.columns)
    assert len(rows) == 48 and all(r["lecturas"] == cars for r in rows)
