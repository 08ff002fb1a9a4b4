"""Declared schemas and the checks that hold rows to them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, comment: str, null: bool = True) -> T.StructField:
    return T.StructField(name, dtype, null, {"comment": comment})


TELEMETRY = T.StructType(
    [
        _field("auto_id", T.IntegerType(), "vehicle that sent the reading", null=False),
        _field("ts", T.TimestampType(), "instant of the reading, UTC", null=False),
        _field("presion_ruedas", T.DecimalType(6, 3), "tyre pressure, bar"),
        _field("nivel_combustible", T.ShortType(), "fuel level, %"),
        _field("carga_bateria", T.ShortType(), "traction battery charge, %"),
        _field("temperatura_motor", T.DecimalType(5, 2), "engine coolant temperature, degrees Celsius"),
        _field("temperatura_bateria", T.DecimalType(5, 2), "battery pack temperature, degrees Celsius"),
        _field("presion_aceite", T.DecimalType(6, 2), "oil pressure, bar"),
        _field("velocidad", T.DecimalType(6, 1), "speed, km/h"),
        _field("revoluciones", T.ShortType(), "engine speed, rpm"),
        _field("consumo_potencia", T.DecimalType(6, 1), "power draw, kW; negative when regenerating"),
        _field("autonomia", T.ShortType(), "estimated remaining range, km"),
    ]
)

KPI = T.StructType(
    [
        _field("ventana", T.TimestampType(), "start of the hour", null=False),
        _field("auto_id", T.IntegerType(), "vehicle", null=False),
        _field("lecturas", T.IntegerType(), "readings in the hour", null=False),
        _field("vel_max", T.DecimalType(6, 1), "highest speed, km/h", null=False),
        _field("rpm_max", T.IntegerType(), "highest engine speed, rpm", null=False),
    ]
)
KPI_KEY = ("ventana", "auto_id")


def comments(schema: T.StructType) -> dict[str, str]:
    """Column comments by name; they travel with the Parquet files."""
    return {f.name: f.metadata["comment"] for f in schema.fields if "comment" in f.metadata}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to ``schema`` in its column order; columns that are not given become NULL."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def enforce_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the job that writes ``df`` when a NOT NULL column holds a null (no extra pass)."""

    def guarded(f: T.StructField) -> Column:
        if f.nullable:
            return F.col(f.name)
        message = F.raise_error(F.lit(f"null value in column {f.name}, declared NOT NULL"))
        checked = F.when(F.col(f.name).isNull(), message.cast(f.dataType)).otherwise(F.col(f.name))
        return checked.alias(f.name, metadata=f.metadata)

    return df.select(*[guarded(f) for f in schema.fields])


def split_valid(
    df: DataFrame, schema: T.StructType, key: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy NOT NULL (and the key, if given) and those that do not.

    Rows of a repeated key are all rejects; nulls in a key are equal. Counting collapses copies before the
    shuffle, so a key with very many copies does not gather in one task; the
    rejects come from a semi join that AQE may split.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required], F.lit(False))
    valid, rejects = df.where(~has_null), df.where(has_null)
    if key:
        counted = valid.groupBy(*key).agg(
            F.count(F.lit(1)).alias("_n"), F.first(F.struct(*df.columns)).alias("_row")
        )
        repeated = counted.where("_n > 1").select(*key).alias("r")
        same = reduce(
            lambda a, b: a & b, [F.col(f"v.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
        )
        rejects = rejects.unionByName(
            valid.alias("v").join(repeated, same, "left_semi").select(*[f"v.{c}" for c in df.columns])
        )
        valid = counted.where("_n = 1").select("_row.*")
    return valid, rejects
