"""Typed scan of a stored table, bound to a contract.

The reference binds each collection to a case class (``.as[T]``): required
columns must exist with compatible types, extra columns are dropped. Here the
contract check happens on the schema (driver-side metadata only) and the
projection keeps column pruning intact: Parquet reads only contract columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _compatible(src: T.DataType, dst: T.DataType) -> bool:
    if isinstance(dst, _INTEGRAL):
        return isinstance(src, _INTEGRAL)
    if isinstance(dst, _FRACTIONAL):
        return isinstance(src, _INTEGRAL + _FRACTIONAL)
    return type(src) is type(dst) or src == dst


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: check presence and widen types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; have {sorted(have)}")
    wrong = [f.name for f in schema.fields if not _compatible(have[f.name], f.dataType)]
    if wrong:
        raise TypeError("incompatible column types: " + ", ".join(
            f"{n} {have[n].simpleString()} -> {schema[n].dataType.simpleString()}" for n in wrong))
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    return conform(spark.read.format(fmt).load(path), schema)
