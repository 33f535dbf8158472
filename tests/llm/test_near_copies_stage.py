"""The near-copies stage of the pipeline takes a similarity of 0.8."""

import corpus_pipeline
from fleetpulse.llm.shingles import shingle_set


def test_stage_takes_four_fifths(spark):
    words = [f"w{k}" for k in range(204)]
    edited = {2: 4, 3: 7}  # words replaced, each in five shingles of its own
    rows = [(1, " ".join(words))]
    for d, n in edited.items():
        rows.append((d, " ".join(f"new{d}x{k}" if k % 10 == 5 and k < 10 * n else w for k, w in enumerate(words))))
    sets = {d: set(shingle_set(t.encode()).tolist()) for d, t in rows}
    alike = {d: len(sets[1] & sets[d]) / len(sets[1] | sets[d]) for d in edited}
    assert 0.8 <= alike[2] < 0.85 and alike[3] < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["minhash_dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == [1, 3]
