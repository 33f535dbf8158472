"""Daily drops as a stream: every new file is one more piece of the input."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.sources.csv_drops import parse_lines, stream_lines


def each_new_drop(
    spark: SparkSession, path: str, state: str, work: Callable[[DataFrame, int], None], files_per_batch: int = 1000
) -> None:
    """Call ``work`` with the normalized snapshots of files not seen before, batch by batch, then stop.

    Files may have headers of their own, and bad ones lie beside good ones: lines are read
    by their file's header, and what can't be used carries its reason. ``state`` keeps the
    files taken in; a batch that did not end is given again with its number.
    """

    def batch(lines: DataFrame, number: int) -> None:
        work(parse_lines(lines), number)

    query = (
        stream_lines(spark, path, files_per_batch)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
