"""op1_url_filters: branches merge at every level, last segments by wildcards only."""

import random
from collections import defaultdict

from parchment.llm import urlfilter as U


def saved(spark, folder, urls, labels):
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def plain(leaves):
    """(host, template, labelled, bad) -> {(host, template): merged}, every place before the last, one after the other."""
    now = {(h, t): tuple(s for s in t.split("/") if s) for h, t, *_ in leaves}
    for place in range(max(map(len, now.values()), default=0) - 2, -1, -1):
        node, pool = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        held = {k: t for k, t in now.items() if len(t) > place + 1 and "*" not in t[place]}
        above = {k: (*t[:place], "*", *t[place + 1 :]) for k, t in held.items()}
        for h, t, n, bad in leaves:
            if (h, t) in held:
                for total in (node[h, held[h, t]], pool[h, above[h, t]]):
                    total[0] += n
                    total[1] += bad
        for k, t in held.items():
            (n, bad), (pn, pb) = node[k[0], t], pool[k[0], above[k]]
            p = pb / pn if pn else 0
            if not n or (bad / n - p) * (bad / n - p) * n <= U.Z * U.Z * p * (1 - p):
                now[k] = above[k]
    return {k: "/" + "/".join(t) for k, t in now.items()}


def test_branches_below_the_first_segment_merge(spark, tmp_path):
    bad = [f"http://h.org/de/p{i}/{100 * i}" for i in range(1, 8)]
    rest = [f"http://h.org/de/p{i}/{100 * i + j}" for i in range(1, 8) for j in range(1, 20)]
    good = [f"http://h.org/en/q/{i}" for i in range(1000, 1400)]
    labels = [(100 * i, 0, 0) for i in range(1, 8)] + [(i, 1, 0) for i in range(1000, 1400)]
    found = {(r.path[:4], r.template, r.verdict) for r in U.op1_url_filters(spark, saved(spark, tmp_path, bad + rest + good, labels)).collect()}
    assert found == {("/de/", "/de/*/*", "block"), ("/en/", "/en/*/*", "allow")}


def test_branches_equal_a_plain_loop(spark):
    rng = random.Random(8)
    leaves = [(f"h{rng.randint(0, 2)}", "/" + "/".join(rng.choice(["a", "b", "c", "*", "d*"]) for _ in range(rng.choice([0, 1, 2, 3, 4, 6]))), n := rng.randint(0, 9), rng.choice([0, 0, n])) for _ in range(500)]
    df = spark.createDataFrame(leaves, "host string, template string, labelled long, bad long")
    rows = U.merged_branches(df).collect()
    assert {(r.host, r.template): r.merged for r in rows} == plain(leaves) and len(rows) == len(plain(leaves))
    assert U.merged_branches(df.limit(0)).count() == 0


def test_two_segments_merge_as_once(spark):
    rng = random.Random(9)
    leaves = [(f"h{rng.randint(0, 3)}", rng.choice(["/", "/x", f"/{rng.choice('abcde')}/{rng.choice('xyz*')}"]), n := rng.randint(0, 30), rng.randint(0, n)) for _ in range(300)]
    df = spark.createDataFrame(leaves, "host string, template string, labelled long, bad long")
    assert sorted(U.merged_branches(df).collect()) == sorted(U.merged_once(df).collect())


def test_levels_follow_forks_and_not_depth(spark, monkeypatch):
    written = []
    stage = U.stage_table
    monkeypatch.setattr(U, "stage_table", lambda df: (written.append(1), stage(df))[1])
    long = "/".join(f"s{i}" for i in range(3000))
    leaves = [("h", f"/{long}/x", 9, 9), ("h", f"/{long[:-1]}z/x", 9, 0), ("h", f"/a/{long}", 1, 0)]
    found = {r.template[-3:]: r.merged for r in U.merged_branches(spark.createDataFrame(leaves, "host string, template string, labelled long, bad long")).collect()}
    stars = "/*" * 2999
    assert found == {"9/x": f"{stars}/s2999/x", "z/x": f"{stars}/s299z/x", "999": f"{stars}/*/s2999"} and len(written) <= 3
