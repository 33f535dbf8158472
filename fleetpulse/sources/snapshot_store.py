"""The stored snapshot table, partitioned by quarter, and its text exchange form."""

import hashlib
import os
from datetime import date as Date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetpulse.schema import SNAPSHOT, SNAPSHOT_KEY
from fleetpulse.session import settle

NULL_TEXT = "\\N"
QUARTER = T.StructField("quarter", T.StringType())


def quarter_of(date: Column) -> Column:
    """Partition label such as 2025q3; labels sort like dates."""
    return F.concat(F.year(date).cast("string"), F.lit("q"), F.quarter(date).cast("string"))


def _quarter_label(day: Date) -> str:
    return f"{day.year}q{(day.month + 2) // 3}"


def append_snapshots(df: DataFrame, path: str) -> None:
    """Append to the table. A daily drop lies in one quarter, so nothing is shuffled."""
    df.withColumn("quarter", quarter_of(F.col("date"))).write.mode("append").partitionBy("quarter").parquet(path)


class BucketedStore:
    """The table that loads write: bucketed and sorted by drive, partitioned by quarter and load.

    ``path/quarter=…/batch=…`` holds the rows of one load. A row that a later load replaces
    stays where it is and is named in ``path/_superseded``; reads leave it out. A load writes
    its own folders only, as a whole, so repeating it changes nothing, and no stored quarter
    is ever written again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """Open the table; ``buckets`` sets their number if it is new."""
        self.spark, self.path = spark, path.rstrip("/")
        layout = _read_if_there(spark, f"{self.path}/_layout", "buckets int")
        if layout is None:
            if buckets is None:
                raise FileNotFoundError(f"no table at {path}")
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{self.path}/_layout")
        else:
            buckets = layout.first().buckets
        self.buckets = buckets
        self.name = "snapshots_" + hashlib.md5(os.path.abspath(self.path).encode()).hexdigest()
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SNAPSHOT)
        location = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, quarter string, batch string) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (quarter, batch) "
            f"CLUSTERED BY (serial_number) SORTED BY (serial_number, date) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.sql(f"MSCK REPAIR TABLE {self.name}")

    @staticmethod
    def exists(spark: SparkSession, path: str) -> bool:
        return _read_if_there(spark, f"{path.rstrip('/')}/_layout", "buckets int") is not None

    def rows(self, but: str | None = None) -> DataFrame:
        """All rows that count, as if the load ``but`` had not been."""
        stored = self.spark.table(self.name)
        gone = _read_if_there(self.spark, f"{self.path}/_superseded", "date date, serial_number string, gone_batch string, by string")
        if but is not None:
            stored = stored.where(F.col("batch") != but)
            gone = None if gone is None else gone.where(F.col("by") != but)
        if gone is None:
            return stored
        # by drive alone, so that the buckets serve the join; a drive has few replaced rows
        lists = gone.groupBy("serial_number").agg(F.collect_set(F.struct("date", "gone_batch")).alias("_gone"))
        replaced = F.coalesce(F.array_contains("_gone", F.struct("date", F.col("batch").alias("gone_batch"))), F.lit(False))
        return stored.join(lists, "serial_number", "left").where(~replaced).select(*stored.columns)

    def dealt(self, df: DataFrame, batch: str) -> DataFrame:
        """The rows of load ``batch``, a partition for each bucket, wherever ``df`` comes from.

        Spark leaves out a shuffle by drive of a table bucketed alike, and then reads that
        table by the size of its files; one by the bucket's number stays.
        """
        rows = df.select(*SNAPSHOT.fieldNames(), quarter_of(F.col("date")).alias("quarter"), F.lit(batch).alias("batch"))
        return rows.repartitionById(self.buckets, F.pmod(F.hash("serial_number"), F.lit(self.buckets)))

    def write(self, df: DataFrame, batch: str) -> None:
        """The rows of load ``batch``, in place of what an earlier try of it wrote; one shuffle."""
        self.dealt(df, batch).write.mode("overwrite").insertInto(self.name)

    def supersede(self, replaced: DataFrame, batch: str) -> None:
        """Note the rows (date, serial_number, gone_batch) that load ``batch`` replaces."""
        replaced.write.mode("overwrite").parquet(f"{self.path}/_superseded/by={batch}")


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_snapshots(
    spark: SparkSession, path: str, start: Date | None = None, end: Date | None = None
) -> DataFrame:
    """Snapshots from ``start`` to ``end``, both included; other quarters are not read."""
    if BucketedStore.exists(spark, path):
        df = BucketedStore(spark, path).rows().select(*SNAPSHOT.fieldNames(), "quarter")
    else:
        df = spark.read.schema(T.StructType([*SNAPSHOT.fields, QUARTER])).parquet(path)
    if start is not None:
        df = df.where((F.col("quarter") >= _quarter_label(start)) & (F.col("date") >= F.lit(start)))
    if end is not None:
        df = df.where((F.col("quarter") <= _quarter_label(end)) & (F.col("date") <= F.lit(end)))
    return df


def calendar(spark: SparkSession, path: str) -> DataFrame:
    """(date, quarter) of every day of the quarters that the table has: at most 92 rows for each."""
    labels = read_snapshots(spark, path).select("quarter").distinct()
    first = F.make_date(F.substring("quarter", 1, 4).cast("int"), F.substring("quarter", 6, 1).cast("int") * 3 - 2, F.lit(1))
    days = F.sequence(first, F.date_sub(F.add_months(first, 3), 1))
    return settle(labels.select("quarter", F.explode(days).alias("date")), "calendar")


def register_view(spark: SparkSession, path: str, name: str = "smart_daily") -> None:
    """Make the table available to ``spark.sql``.

    Its dates come from a calendar that is joined by day and quarter, so a filter on ``date``
    selects days of the calendar, and Spark prunes the quarters by those that remain. The
    view has the quarters of the time it is registered; register it again after a load.
    """
    days = calendar(spark, path)
    stored = read_snapshots(spark, path).withColumnRenamed("date", "_date").withColumnRenamed("quarter", "_quarter")
    rows = stored.join(days, (F.col("_quarter") == F.col("quarter")) & (F.col("_date") == F.col("date")))
    rows.select(*SNAPSHOT.fieldNames(), "quarter").createOrReplaceTempView(name)


def around(stored: DataFrame, df: DataFrame) -> DataFrame:
    """The rows of the table in the quarters and between the dates that ``df`` has: two numbers and a short list of labels."""
    found = df.agg(F.collect_set(quarter_of(F.col("date"))).alias("q"), F.min("date").alias("low"), F.max("date").alias("high")).first()
    return stored.where(F.col("quarter").isin(found.q) & F.col("date").between(F.lit(found.low), F.lit(found.high)))


def write_exchange(df: DataFrame, path: str) -> None:
    """Tab-separated text without a header; NULL is written as a marker."""
    df.write.option("sep", "\t").option("nullValue", NULL_TEXT).csv(path)


def read_exchange(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).option("sep", "\t").option("nullValue", NULL_TEXT).csv(path)
