"""The training sample stays within its bound, whatever rows repeat, and the query keeps its contract."""

import zlib

from gridloom.llm import quality_model, queries

SMALL = "/root/testdata/sf0.01"


def test_repeated_rows_of_labelled_documents(spark):
    docs = spark.createDataFrame([(i % 4, f"words of {i} and some more {i * 7}") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0), (3, 1, 1), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    sample = quality_model.training_sample(docs, labels).collect()
    known = {(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    assert sorted((r.doc_id, r.quality) for r in sample) == sorted(known)
    assert len(sample) <= 2 * quality_model.PER_CLASS


def test_contract_columns_and_held_out_ranking(spark):
    rows = queries.op6_quality_classifier(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    by_text = {}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert abs(by_text.setdefault(texts[r.doc_id] or "", r.score) - r.score) < 1e-6  # equal texts, equal scores
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, poor = ([s for s, q in held if q == v] for v in (1, 0))
    auc = sum((g > p) + 0.5 * (g == p) for g in good for p in poor) / (len(good) * len(poor))
    assert auc >= 0.95
