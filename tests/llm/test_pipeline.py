import hashlib

import numpy as np

import corpus_pipeline as P
from parchment.llm import bpe, neardup
from parchment.llm.common import stage_table

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in P.STAGES:
        before = docs
        docs = stage_table(stage(spark, docs, SF))
        seen.append((name, before, docs))
        if name != "byte_bpe":
            assert docs.columns == before.columns
    by = {name: (a, b) for name, a, b in seen}
    a, b = by["quality_rules"]
    assert 0 < b.count() < a.count() and b.join(a, a.columns, "left_anti").count() == 0
    a, b = by["minhash_near_dedup"]
    left = [r.text for r in b.collect()]
    assert len({r.doc_id for r in b.collect()}) == len(left)
    for r in a.collect():  # every document has itself or a copy left
        assert r.text in left or any(neardup.alike(r.text.encode(), t.encode()) for t in left)
    assert not any(neardup.alike(s.encode(), t.encode()) for i, s in enumerate(left) for t in left[:i])
    a, b = by["suffix_array_dedup"]
    assert a.count() == b.count()
    a, b = by["source_mixing"]
    texts = {r.text for r in a.collect()}
    assert all(r.text in texts or any(w in " ".join(texts) for w in r.text.split()[:1]) for r in b.collect())
    a, b = by["byte_bpe"]
    enc = bpe.encoding()
    want = sorted((r.doc_id, hashlib.sha256(np.asarray(enc.encode_ordinary(r.text), "<u4").tobytes()).hexdigest()) for r in a.collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in b.collect()) == want
