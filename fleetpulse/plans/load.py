"""Load of CSV drops into the stored snapshot table, all at once or file by file."""

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetpulse.operators.keys import few_repeated_keys, one_row_per_key, surplus_rows
from fleetpulse.schema import SNAPSHOT, SNAPSHOT_KEY
from fleetpulse.session import settle
from fleetpulse.sources.csv_drops import FILE, REASON, accepted, load_audit, read_drops, rejected
from fleetpulse.sources.snapshot_store import BucketedStore, around
from fleetpulse.sources.tables import bucket_count
from fleetpulse.streaming.drops import each_new_drop

TEXT_PER_BUCKET = 64 * 1024 * 1024  # a reading takes some 110 bytes as text

ORDER = [c for c in SNAPSHOT.fieldNames() if c not in SNAPSHOT_KEY]


def store(parsed: DataFrame, table: str, quarantine: str, batch: str, buckets: int) -> None:
    """Add parsed snapshots to the table, each key once, as the load ``batch``.

    Of the rows of a key the least in ``ORDER`` stays, whichever load brings it: it takes the
    place of a stored row that comes after it. Rows without a usable key, surplus rows of a
    key, replaced rows, and rows whose key the table already holds go to ``quarantine`` with
    a reason. Table and quarantine keep the rows of a load apart by its name, so a load that
    broke off is repeated under its name and leaves both as if it had run once.
    """
    new = not BucketedStore.exists(parsed.sparkSession, table)
    target = BucketedStore(parsed.sparkSession, table, buckets)
    usable = accepted(parsed)
    repeated = few_repeated_keys(usable, SNAPSHOT_KEY)
    several = settle(usable.join(repeated, SNAPSHOT_KEY, "left_semi").select(*usable.columns), "repeated-rows")
    single = usable.join(repeated, SNAPSHOT_KEY, "left_anti").select(*usable.columns)
    once = F.lit(1).cast("long")
    out = (
        rejected(parsed).drop(FILE).withColumn("copies", once)
        .unionByName(surplus_rows(several, SNAPSHOT_KEY, ORDER).withColumn(REASON, F.lit("repeated key")))
    )
    unique = single.unionByName(one_row_per_key(several, SNAPSHOT_KEY, ORDER))
    better = None
    if not new:
        stored = around(target.rows(but=batch), usable)
        held = stored.select(*SNAPSHOT_KEY, F.struct(*ORDER).alias("_held"), F.col("batch").alias("gone_batch"))
        met = settle(unique.join(held, SNAPSHOT_KEY), "met-keys")
        before = F.struct(*ORDER) < F.col("_held")
        known = met.where(~before).select(*unique.columns).withColumn("copies", once)
        out = out.unionByName(known.withColumn(REASON, F.lit("key already stored")))
        better = met.where(before)
        replaced = better.select(*SNAPSHOT_KEY, "_held.*").withColumn("copies", once)
        out = out.unionByName(replaced.withColumn(REASON, F.lit("repeated key")))
        unique = unique.join(met.where(~before).select(*SNAPSHOT_KEY), SNAPSHOT_KEY, "left_anti")
    # Independent jobs over the same stored rows; the small ones need not wait.
    with ThreadPoolExecutor(3) as pool:
        jobs = [
            pool.submit(out.write.mode("overwrite").parquet, f"{quarantine}/batch={batch}"),
            pool.submit(target.write, unique, batch),
        ]
        if better is not None and not better.isEmpty():
            jobs.append(pool.submit(target.supersede, better.select(*SNAPSHOT_KEY, "gone_batch"), batch))
        for job in jobs:
            job.result()


def load_drops(
    spark: SparkSession, raw_path: str, table: str, quarantine: str, per: str = "file",
    batch: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """Load every CSV under ``raw_path``; return rows read and rejected per file.

    The text is parsed once, into the shared folder. ``batch`` names the load: one that is
    repeated under the same name replaces what it wrote before. ``buckets`` is the number for
    a new table, by default one per core, more as the files grow.
    """
    parsed = settle(read_drops(spark, raw_path, per), "parsed-drops")
    store(parsed, table, quarantine, batch or f"load-{uuid.uuid4().hex}", buckets or bucket_count(spark, raw_path, TEXT_PER_BUCKET))
    return load_audit(parsed)


def load_new_drops(
    spark: SparkSession, raw_path: str, table: str, quarantine: str, state: str, header: list[str] | None = None,
    files_per_batch: int = 1000, buckets: int | None = None,
) -> None:
    """Load the files that were not seen before, then stop.

    Each file is read by its own header, so ``header`` is no longer needed.
    ``files_per_batch`` has no part in which rows are stored. ``state`` keeps the list of
    files taken in, and the number of a batch names its load: one that is repeated after a
    failure changes neither the table nor the quarantine.
    """
    source = hashlib.md5(state.rstrip("/").encode()).hexdigest()[:12]
    buckets = buckets or bucket_count(spark, raw_path, TEXT_PER_BUCKET)

    def work(parsed: DataFrame, number: int) -> None:
        store(settle(parsed, "parsed-batch"), table, quarantine, f"stream-{source}-{number}", buckets)

    each_new_drop(spark, raw_path, state, work, files_per_batch)
