"""Search of many shards by few tasks."""

import numpy as np

from parchment.llm import ann


def test_graphs_do_not_travel_with_each_block_of_queries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8 if i % 3 else 5).tolist()) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), shard_size=20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for q in range(0, 600, 50):
        same = [i for i in unit if i != q and len(unit[i]) == len(unit[q])]
        assert [got[q][r] for r in range(1, 6)] == sorted(same, key=lambda i: -float(unit[i] @ unit[q]))[:5]
