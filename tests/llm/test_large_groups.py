"""Groups of stretches beyond the size one task holds."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import suffix_dedup


def brute(rows):
    seen, want = set(), {}
    for d, t in rows:
        data = t.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(data[k : k + 100])
        want[d] = (sum(gone), hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest())
    return want


def passages(n):
    """One passage, whole or cut, in ``n`` documents that surround it by bytes of their own."""
    r = random.Random(12)
    shared = "".join(r.choices("abcdefgh ", k=230))
    rows = []
    for k in range(n):
        a, b = ("".join(r.choices("ijklmnop ", k=r.randrange(20, 150))) for _ in range(2))
        cut = r.choice([0, 0, 0, 40, 90])
        rows.append((k, a + shared[cut : 230 - r.choice([0, 0, 35])] + b))
    return rows + [(n, rows[3][1]), (n + 1, "x" * 400)]


@pytest.mark.parametrize("group_rows", [10, 5_000])
def test_large_groups_equal_brute_force(spark, monkeypatch, group_rows):
    rows = passages(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sizes = spark.sparkContext.accumulator(0)
    sort = suffix_dedup._sorted_suffixes

    def counted(length, rows_at_once):
        def batches(stream):
            def noted():
                last, n = None, 0
                for batch in stream:
                    for key in batch["key"].to_pylist():
                        n = n + 1 if key == last else 1
                        last = key
                        if n == 11:
                            sizes.add(1)
                    yield batch

            yield from sort(length, rows_at_once)(noted())

        return batches

    monkeypatch.setattr(suffix_dedup, "_sorted_suffixes", counted)
    got = suffix_dedup.dedup_bytes(docs, ["doc_id"], group_rows=group_rows).select("doc.doc_id", "n_removed", F.sha2("kept", 256)).collect()
    assert {x[0]: tuple(x)[1:] for x in got} == brute(rows)
    assert (sizes.value > 0) == (group_rows > 300)


def test_a_group_beyond_the_size_of_a_task(spark):
    """6,000 documents around one passage: groups of more rows than ``group_rows`` allows by default."""
    rows = passages(6_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = suffix_dedup.dedup_bytes(docs, ["doc_id"]).select("doc.doc_id", "n_removed", F.sha2("kept", 256)).collect()
    assert {x[0]: tuple(x)[1:] for x in got} == brute(rows)
