"""Tables derived from the given ones, and single lines of drops."""

import pytest
from pyspark.sql import functions as F

from fleetpulse.session import shared_folder
from fleetpulse.sources import csv_drops, tables


def test_long_part_keys_stay_apart(spark, small, tmp_path):
    for name in ("lineitem", "part"):
        key = {"lineitem": "l_partkey", "part": "p_partkey"}[name]
        df = spark.read.parquet(f"{small}/{name}.parquet")
        df.withColumn(key, F.col(key).cast("long") + 1_000_000_000).write.parquet(f"{tmp_path}/{name}.parquet")
    drives = tables.smart_raw(spark, str(tmp_path)).select("serial_number").distinct()
    assert drives.count() == tables.smart_raw(spark, small).select("serial_number").distinct().count()


def test_blank_first_file_keeps_its_directory(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n")
    (tmp_path / "b.csv").write_text("date,serial_number,failure\n2020-01-01,A,0\n2020-01-02,A,1\n")
    for per in ("file", "directory"):
        parsed = csv_drops.read_drops(spark, str(tmp_path), per)
        assert csv_drops.accepted(parsed).count() == 2


def test_dates_and_flags_are_read_whole(spark):
    rows = [("2020-01-01", "1"), ("2020-01-01 10:00:00", "3000000000"), ("2020-01-01junk", "0"), ("2020-01-01 junk", "0")]
    raw = spark.createDataFrame([(d, "A", f) for d, f in rows], "date string, serial_number string, failure string")
    parsed = csv_drops.normalize(raw)
    assert sorted(r.failure for r in csv_drops.accepted(parsed).collect()) == [0, 1]
    assert csv_drops.rejected(parsed).count() == 2


def test_cluster_without_a_shared_folder_is_told_so(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
