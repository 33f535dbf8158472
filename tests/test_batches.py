"""Loads of the same drops store the same table, however the files are batched."""

import os

from fleetpulse.plans import load
from fleetpulse.plans.load import load_drops, load_new_drops
from fleetpulse.sources import snapshot_store
from fleetpulse.sources.tables import bucket_count

HEADER = "date,serial_number,model,capacity_bytes,failure,smart_5_raw,smart_9_raw"
FILES = [
    "2025-01-01,A,M,1,0,9,1\n2025-01-01,B,M,1,0,2,2\n",
    "2025-01-01,A,M,1,0,1,7\n2025-04-01,C,M,1,0,,3\n2025-01-01,B,M,1,0,3,1\n",
    "2025-01-01,A,M,1,0,4,0\n2025-04-01,C,M,1,0,5,3\n2025-01-01,B,M,1,0,,8\n",
]


def test_batches_store_the_same_rows(spark, tmp_path):
    raw = tmp_path / "drops"
    raw.mkdir()
    for k, text in enumerate(FILES):
        (raw / f"{k}.csv").write_text(f"{HEADER}\n{text}")
        os.utime(raw / f"{k}.csv", (1_700_000_000 + k, 1_700_000_000 + k))
    found, refused = {}, {}
    for n in (1, 1000):
        where = [str(tmp_path / f"{part}-{n}") for part in ("table", "refused", "state")]
        load_new_drops(spark, str(raw), *where, HEADER.split(","), files_per_batch=n)
        found[n], refused[n] = where[0], where[1]
    found["bulk"], refused["bulk"] = str(tmp_path / "bulk"), str(tmp_path / "bulk-refused")
    load_drops(spark, str(raw), found["bulk"], refused["bulk"])
    for n in found:
        rows = snapshot_store.read_snapshots(spark, found[n]).orderBy("serial_number").collect()
        assert [(r.serial_number, r.smart_5_raw, r.smart_9_raw) for r in rows] == [("A", 1, 7), ("B", None, 8), ("C", None, 3)], n
        out = spark.read.parquet(refused[n]).orderBy("serial_number", "smart_5_raw").collect()
        assert [(r.serial_number, r.smart_5_raw, r.copies) for r in out] == [("A", 4, 1), ("A", 9, 1), ("B", 2, 1), ("B", 3, 1), ("C", 5, 1)], n


def test_rows_of_repeated_keys_are_looked_up_once(spark, tmp_path, monkeypatch):
    raw = tmp_path / "drops"
    raw.mkdir()
    (raw / "0.csv").write_text(f"{HEADER}\n{''.join(FILES)}")
    stored = []
    whole = load.settle
    monkeypatch.setattr(load, "settle", lambda df, name: stored.append((name, whole(df, name))) or stored[-1][1])
    load.load_drops(spark, str(raw), str(tmp_path / "table"), str(tmp_path / "refused"))
    found = dict(stored)["repeated-rows"]
    assert sorted(r.serial_number for r in found.collect()) == ["A"] * 3 + ["B"] * 3 + ["C"] * 2


def test_buckets_of_text_hold_fewer_than_a_million_readings(spark, tmp_path):
    (tmp_path / "drops").mkdir()
    with open(tmp_path / "drops" / "0.csv", "wb") as f:
        f.truncate(4 << 30)  # a sparse file: only its length counts
    assert bucket_count(spark, str(tmp_path / "drops"), load.TEXT_PER_BUCKET) >= (4 << 30) // 110 // 1_000_000
