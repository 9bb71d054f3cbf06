"""A source far below a millionth of all words stays in the mix."""

from parchment.llm import mixing


def test_small_sources_reach_their_targets(spark):
    sizes = [("a", 100_000_000)] * 100 + [("b", 100)] * 3 + [("c", 900_000_000)] * 2 + [("d", 0)]
    rows = [(i, source, size, f"{i * 7919 % 104729:032x}") for i, (source, size) in enumerate(sizes)]
    found = mixing.mix_sized(spark.createDataFrame(rows, "doc_id long, source string, size long, h string")).collect()
    taken, target = {}, {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert target["b"] == 600 and taken["b"] == 600 and taken["d"] == 0
    assert all(abs(taken[s] - target[s]) <= 1e-6 * sum(target.values()) for s in target)
