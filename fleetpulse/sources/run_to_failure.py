"""Run-to-failure series in headerless whitespace-delimited text, and their CSV form."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleetpulse.schema import SENSOR_READINGS


def read_series(spark: SparkSession, path: str, schema: T.StructType = SENSOR_READINGS) -> DataFrame:
    """One row per line, columns by position; runs of blanks separate them."""
    parts = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    lines = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("_parts"))
    return lines.select(
        *[F.get("_parts", F.lit(i)).cast("double").cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """The one-column file of remaining lives."""
    return read_series(spark, path, T.StructType([T.StructField("RUL", T.IntegerType())]))


def write_series(df: DataFrame, path: str) -> None:
    """Blank-separated lines without a header."""
    df.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns])).write.text(path)


def write_labelled(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_labelled(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
