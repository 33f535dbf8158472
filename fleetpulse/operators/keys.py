"""Key uniqueness, key lookups and key sampling."""

from pyspark.sql import DataFrame, Window as W, functions as F

from fleetpulse.session import settle

MANY_ROWS = 20_000  # a drive has a row a day; one with more has many copies


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. Counts only the key columns, map-side first."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)


def few_repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The repeated keys, stored; how they are joined is left to their size as Spark knows it."""
    return settle(repeated_keys(df, keys), "repeated-keys")


def one_row_per_key(
    df: DataFrame, keys: list[str], order: list[str], repeated: DataFrame | None = None
) -> DataFrame:
    """Keep the first row of every key in ``order``; remaining columns break ties.

    Spark limits a ``row_number() = 1`` filter to one row per key in every map task
    before the shuffle, so a key with very many copies costs no more than any other.
    Given the few ``repeated`` keys, only their rows are sorted; all others pass through.
    """
    if repeated is not None:
        several = df.join(repeated, keys, "left_semi").select(*df.columns)
        single = df.join(repeated, keys, "left_anti").select(*df.columns)
        return single.unionByName(one_row_per_key(several, keys, order))
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    w = W.partitionBy(*keys).orderBy(*rest)
    return df.withColumn("_row", F.row_number().over(w)).where("_row = 1").drop("_row")


def busy_keys(df: DataFrame, column: str, rows: int = MANY_ROWS) -> DataFrame:
    """Values of ``column`` in more than ``rows`` rows, stored: at most one for every so many rows of ``df``."""
    return settle(df.groupBy(column).agg(F.count("*").alias("_n")).where(F.col("_n") > rows).select(column), "busy-keys")


def one_row_per_key_within(
    df: DataFrame, within: str, keys: list[str], order: list[str], parts: int, busy: DataFrame
) -> DataFrame:
    """``one_row_per_key`` in ``parts`` partitions by ``within``, one of the keys, in one shuffle.

    Rows of ``busy`` values of ``within`` go through ``one_row_per_key`` first, which finds the
    first row of a key map-side, so no partition gets a key's many copies. Rows without a
    whole key are no copies of each other: all stay, in the order they come in.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    dealt = df
    if not busy.isEmpty():
        listed = busy.select(F.col(within).alias("_busy"))
        many = (F.col(within) == F.col("_busy")) & whole
        met = one_row_per_key(df.join(listed, many, "left_semi"), keys, order)
        dealt = df.join(listed, many, "left_anti").unionByName(met)
    dealt = dealt.repartition(parts, within).withColumn("_alone", F.when(~whole, F.monotonically_increasing_id()))
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    # ``within`` leads, so that rows leave in its order and a table sorted by it finds them sorted.
    by = [within, *[k for k in keys if k != within]]
    first = F.row_number().over(W.partitionBy(*by, "_alone").orderBy(*rest))
    return dealt.withColumn("_row", first).where("_row = 1").drop("_row", "_alone")


def surplus_rows(
    df: DataFrame, keys: list[str], order: list[str], repeated: DataFrame | None = None
) -> DataFrame:
    """The rows ``one_row_per_key`` leaves out, with ``copies`` of each.

    Equal rows are folded into one with their count before the shuffle, and the first row
    of a key is found map-side. Given the few ``repeated`` keys, only their rows take part.
    """
    rows = df if repeated is None else df.join(repeated, keys, "left_semi").select(*df.columns)
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    folded = rows.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    first = folded.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    is_kept = F.struct(*rest).eqNullSafe(F.col("_first"))
    return (
        folded.join(first, keys)
        .withColumn("copies", F.col("copies") - is_kept.cast("long"))
        .where("copies > 0")
        .select(*df.columns, "copies")
    )


def failed_drives(df: DataFrame) -> DataFrame:
    """Distinct (serial_number, failure_date)."""
    return (
        df.where(F.col("failure") == 1)
        .select("serial_number", F.col("date").alias("failure_date"))
        .distinct()
    )


def failure_dates(df: DataFrame, pick: str = "max") -> DataFrame:
    """One failure date per failed drive, the last one by default."""
    choose = {"max": F.max, "min": F.min}[pick]
    return (
        df.where(F.col("failure") == 1)
        .groupBy("serial_number")
        .agg(choose("date").alias("failure_date"))
    )


def never_failed(df: DataFrame) -> DataFrame:
    """Serial numbers without any failure row."""
    failed = df.where(F.col("failure") == 1).select("serial_number").distinct()
    return df.select("serial_number").distinct().join(failed, "serial_number", "left_anti")


def rows_of(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose serial number is among ``keys``; Spark broadcasts small key sets itself."""
    return df.join(keys.select("serial_number"), "serial_number", "left_semi").select(*df.columns)


def with_failure_date(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Look up the failure date of each row's drive; NULL for drives that never failed."""
    return df.join(dates, "serial_number", "left")


def sample_keys(keys: DataFrame, n: int, seed: int = 42, column: str = "serial_number") -> DataFrame:
    """A repeatable uniform sample of ``n`` keys: the n smallest seeded digests."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(column)))
    return keys.select(column).orderBy(digest, column).limit(n)
