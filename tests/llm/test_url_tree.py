"""The tree of templates against plain loops, level by level."""

import random
from collections import defaultdict

from parchment.llm import urlfilter as U


def plain(leaves):
    """(host, template, labelled, bad) -> {(host, template): (merged, purity)}."""
    now, m, b = {}, defaultdict(int), defaultdict(int)
    for host, template, n, bad in leaves:
        now[host, template] = tuple(s for s in template.split("/") if s)
        m[host, template] += n
        b[host, template] += bad
    for place in range(max(map(len, now.values()), default=0) - 1, -1, -1):
        node, pool = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        up = lambda t: (*t[:place], "*", *t[place + 1 :])  # noqa: E731, B023
        for k, t in now.items():
            if len(t) > place and "*" not in t[place]:
                for total in (node[k[0], t], pool[k[0], up(t)]):
                    total[0] += m[k]
                    total[1] += b[k]
        for k, t in list(now.items()):
            if (k[0], t) in node:
                (n, bad), (pn, pb) = node[k[0], t], pool[k[0], up(t)]
                p = pb / pn if pn else 0
                if not n or (bad / n - p) * (bad / n - p) * n <= U.Z * U.Z * p * (1 - p):
                    now[k] = up(t)
    smooth = lambda good, n, prior: (good + U.PRIOR * prior) / (n + U.PRIOR)
    total = lambda d, ok: sum(v for k, v in d.items() if ok(k))
    every = smooth(sum(m.values()) - sum(b.values()), sum(m.values()), 1.0)
    out = {}
    for k, t in now.items():
        same, host = (lambda x: x[0] == k[0] and now[x] == t), (lambda x: x[0] == k[0])  # noqa: B023
        hm, mm = total(m, host), total(m, same)
        out[k] = ("/" + "/".join(t), smooth(mm - total(b, same), mm, smooth(hm - total(b, host), hm, every)))
    return out


def test_tree_equals_a_plain_loop(spark):
    rng = random.Random(5)
    leaves = [(f"h{rng.randint(0, 2)}", "/" + "/".join(rng.choice(["a", "b", "c", "*"]) for _ in range(rng.choice([0, 1, 2, 3, 5]))), n := rng.randint(0, 9), rng.choice([0, 0, n])) for _ in range(400)]
    df = spark.createDataFrame(leaves, "host string, template string, labelled long, bad long")
    found = {(r.host, r.template): (r.merged, r.purity) for r in U.judged_templates(df, U.merged_by_level).collect()}
    want = plain(leaves)
    assert found.keys() == want.keys()
    assert all(found[k][0] == want[k][0] and abs(found[k][1] - want[k][1]) < 1e-12 for k in want)
    assert U.judged_templates(df.limit(0), U.merged_by_level).count() == 0


def test_siblings_below_the_first_segment_are_pooled(spark):
    host = "http://h.org"
    bad = [f"{host}/de/p{i}/0" for i in range(1, 8)]
    good = [f"{host}/en/q/{i}" for i in range(400)]
    urls = bad + [f"{host}/de/p{i}/{j}" for i in range(1, 8) for j in range(1, 20)] + good
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(u, 1) for u in bad] + [(u, 0) for u in good], "url string, bad int")
    verdicts = lambda **a: {(r.path.startswith("/de/"), r.template, r.verdict) for r in U.judge(pages, labels, rules=(("allow", "none.org/"),), **a).collect()}
    assert verdicts(merging=U.merged_by_level) == {(True, "/de/*/*", "block"), (False, "/en/*/*", "allow")}
    assert all(v == "allow" for de, _, v in verdicts() if de)
