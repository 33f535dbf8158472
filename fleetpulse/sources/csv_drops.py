"""Daily CSV drops: discovery, reading by header, normalization."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleetpulse.schema import RAW_ATTRIBUTES, SNAPSHOT
from fleetpulse.session import settle

FILE = "source_file"
REASON = "reject_reason"
FOREIGN = "foreign header"
NEEDED = ["date", "serial_number"]


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select("path", "length")
    )


def find_csv_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every CSV file under ``path``, once each, sorted; no content is read."""
    return _listed(spark, path).orderBy("path")


def _with_places(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, source_file, block): the lines of every CSV file under ``path``."""
    reader = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return _with_places(reader.load(path))


def stream_lines(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """``read_lines`` as a stream of new files; a file is never cut between two batches."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return _with_places(reader.option("maxFilesPerTrigger", files_per_batch).load(path))


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_file, header): the first line of each file that is not blank, for all files in one job.

    Each task finds the first line of what it reads of a file, so one row per file and task
    is shuffled and nothing is listed on the driver. Files without such a line do not appear.
    """
    at = F.struct("block", F.monotonically_increasing_id())
    placed = lines.select(FILE, "value", at.alias("at")).where(F.trim("value") != "")
    return placed.groupBy(FILE).agg(F.min_by("value", "at").alias("header"))


def _columns_of(headers: DataFrame) -> tuple[DataFrame, list[str]]:
    """Adds ``places``: where each snapshot column stands in the header, from 1, or 0; and names of the widest file's cells."""
    commas = F.length("header") - F.length(F.translate("header", ",", ""))
    width = (headers.agg(F.max(commas)).first()[0] or 0) + 1
    cells = [f"c{k}" for k in range(width)]
    names = F.from_csv("header", ", ".join(f"{c} string" for c in cells))
    headers = headers.select("*", names.alias("names"))
    held = F.array(*[F.col(f"names.{c}") for c in cells])
    places = [F.array_position(held, name).cast("int").alias(name) for name in SNAPSHOT.fieldNames()]
    return headers.select(FILE, "header", F.struct(*places).alias("places")), cells


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines of files with headers of their own as normalized snapshots, with file name and reject reason.

    Files are grouped by nothing: each line is read by the places that its own file's header
    gives to the snapshot columns, in one pass for any number of headers. A line equal to its
    file's header is a header, wherever it stands. All lines of a file whose header lacks
    the date or the serial number are rejected as of a foreign header.
    """
    headers, cells = _columns_of(settle(file_headers(lines), "headers"))
    rows = lines.join(headers, FILE).where((F.trim("value") != "") & (F.col("value") != F.col("header")))
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in cells))
    # Generated, so that a filter on what is read from a line does not parse it again for every column.
    rows = rows.select(FILE, "places", F.inline(F.array(parsed)))
    rows = rows.select(FILE, "places", F.array(*cells).alias("cells"))

    def text(name: str) -> Column:
        return F.get("cells", F.col(f"places.{name}") - 1)

    def has(name: str) -> Column:
        return F.col(f"places.{name}") > 0

    foreign = ~(has(NEEDED[0]) & has(NEEDED[1]))
    return _snapshots(rows, text, has, foreign)


def text_schema(names: tuple[str, ...] | list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _whole_number(value: Column) -> Column:
    """Lenient integer: fractions are cut off, anything unreadable is NULL."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))


def _snapshots(raw: DataFrame, text: Callable[[str], Column], has: Callable[[str], Column], foreign: Column) -> DataFrame:
    date = text("date").try_cast("timestamp_ntz").try_cast("date")
    columns = {
        "date": date,
        "serial_number": text("serial_number"),
        "model": F.when(has("model"), text("model")).otherwise(F.lit("")),
        "capacity_bytes": _whole_number(text("capacity_bytes")),
        "failure": F.coalesce(_whole_number(text("failure")).try_cast("int"), F.lit(0)),
    }
    columns |= {a: _whole_number(text(a)) for a in RAW_ATTRIBUTES}
    reason = (
        F.when(foreign, FOREIGN)
        .when(date.isNull(), "unreadable date")
        .when(text("serial_number").isNull(), "no serial number")
    )
    kept = [FILE] if FILE in raw.columns else []
    return raw.select(*[c.alias(n) for n, c in columns.items()], reason.alias(REASON), *kept)


def normalize(raw: DataFrame) -> DataFrame:
    """Project text columns to the typed snapshot, plus ``reject_reason`` for unusable rows.

    Attributes the drop does not have become NULL, an unreadable number becomes NULL,
    an unknown or out of range failure flag 0, an absent model column the empty text. A row
    without a date that is readable as a whole or without a serial number is marked for rejection.
    """

    def text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    return _snapshots(raw, text, lambda name: F.lit(name in raw.columns), F.lit(False))


def read_drops(spark: SparkSession, path: str, per: str = "file") -> DataFrame:
    """Every CSV under ``path`` as normalized snapshots, with file name and reject reason.

    Each file is read by its own header; ``per`` ("file" or "directory") once saved headers
    from being read and makes no difference any more.
    """
    lines = read_lines(spark, path)
    if lines.where(F.trim("value") != "").isEmpty():
        raise FileNotFoundError(f"no CSV files with a header under {path}")
    return parse_lines(lines)


def blank_files(spark: SparkSession, path: str) -> DataFrame:
    """CSV files under ``path`` with nothing but blank lines. Files without a byte are left out: Spark reads none."""
    return _listed(spark, path).select(F.col("path").alias(FILE)).join(file_headers(read_lines(spark, path)), FILE, "left_anti")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNull()).select(*SNAPSHOT.fieldNames())


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON).isNotNull())


def load_audit(parsed: DataFrame) -> DataFrame:
    """Rows read and rejected per file."""
    return parsed.groupBy(FILE).agg(
        F.count("*").alias("rows"), F.count(REASON).alias("rejected_rows")
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """Files, files with usable rows, and rows loaded."""
    loaded = F.col("rows") - F.col("rejected_rows")
    return audit.agg(
        F.count("*").alias("files"),
        F.count_if(loaded > 0).alias("successful_files"),
        F.coalesce(F.sum(loaded), F.lit(0)).alias("total_rows"),
    )
