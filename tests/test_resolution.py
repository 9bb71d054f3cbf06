"""Resolution against one loop over all pairs, with its constraints; screens, graph and exports."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from parchment.functions.names import same_person, similarity, tokens
from parchment.functions.text import FOLDS
from parchment.operators import blocks, graph, resolution
from parchment.operators.resolution import AGREEMENT

import re


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    given, last = ["Juan", "Xuan", "Maria", "María", "Blas", "Fray Luis"], ["Perez", "Peres", "Gomes", "Lopez", "Lopes Diaz", ""]
    people, relations, events, principals = [], [], [], []
    for e in range(70):
        entry = f"{e // 3:04d}-{e % 3:02d}" if e % 9 else f"x{e}"
        for p in range(rng.randint(1, 4)):
            name = None if rng.random() < 0.03 else f"{rng.choice(given)} {rng.choice(last)}".strip()
            people.append((0, entry, e, p, f"P{p}", name, rng.choice([None, "parda", "Parda ", "negra", ""]), rng.choice([None, "true", "false"]), rng.choice([None, "Cuba"]), rng.choice([None, None, "cura"])))
            for k in range(rng.randint(0, 2)):
                relations.append((0, entry, f"P{p}", k, f"P{rng.randint(0, 4)}", rng.choice(["spouse", "Parent", "godparent", "enslaver"])))
        if rng.random() < 0.9:
            events.append((0, entry, 0, rng.choice(["Baptism", "marriage"]), rng.choice([None, "1700-01-02", "1810", "1750-02"])))
            principals.append((0, entry, 0, 0, "P0"))
    return (
        spark.createDataFrame(people, "volume int, entry string, ord int, pos int, id string, name string, phenotype string, free string, origin string, occupation string"),
        spark.createDataFrame(relations, "volume int, entry string, id string, pos int, related_person string, relationship_type string"),
        spark.createDataFrame(events, "volume int, entry string, pos int, type string, date string"),
        spark.createDataFrame(principals, "volume int, entry string, event int, pos int, id string"),
    )


@pytest.fixture(scope="module")
def found(tables):
    m = resolution.mentions(*tables).cache()
    return m, resolution.resolve(m, stage=lambda df: df.cache())


def sound(name):
    t = tokens(name or "")
    if not t:
        return ""
    x = t[0]
    for a, b in FOLDS:
        x = re.sub(a, b.replace("$1", r"\1"), x)
    return x


def one_loop(m):
    """Scores, decisions and clusters of all pairs in order."""
    m = sorted(m, key=lambda r: r.idx)
    blocks = {}
    for r in m:
        blocks.setdefault(sound(r.name), []).append(r)
    parent, surnames = {r.idx: r.idx for r in m}, {r.idx: set() for r in m}
    for r in m:
        t = tokens(r.name or "")
        if len(t) > 1:
            surnames[r.idx] = {t[-1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    value = lambda r, k: (getattr(r, k, None) or "").strip().lower() or None
    queue, edges, kept = [], [], 0
    for rows in blocks.values():
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                if a.entry == b.entry:
                    continue
                ca, cb = {(c.type, c.name) for c in a.context}, {(c.type, c.name) for c in b.context}
                near = a.year is None or b.year is None or abs(a.year - b.year) <= 60
                if not (a.register and a.register == b.register or {n for _, n in ca} & {n for _, n in cb} or near):
                    continue
                kept += 1
                s = similarity(tokens(a.name or ""), tokens(b.name or ""))
                if s <= 0:
                    continue
                hit = False
                clash = 0
                for k, w in AGREEMENT.items():
                    x, y = value(a, k), value(b, k)
                    if x and y:
                        s += w if x == y else 0
                        clash += x != y
                s -= 0.25 * clash
                if ca & cb:
                    hit = True
                    s += min(0.15, 0.05 * len(ca & cb))
                for t in resolution.TELLING:
                    x, y = [n for k, n in ca if k == t], [n for k, n in cb if k == t]
                    if x and y:
                        if any(same_person(p, q) for p in x for q in y):
                            hit = True
                        else:
                            s -= 0.35
                if len(tokens(a.name or "")) == len(tokens(b.name or "")) == 1 and not hit:
                    s = min(s, 0.82)
                s = max(0.0, min(1.0, s))
                if a.once and b.once and s >= 0.7:
                    queue.append((a.idx, b.idx, round(min(s, 0.85), 3)))
                elif s >= 0.86:
                    x, y = root(a.idx), root(b.idx)
                    if surnames[x] and surnames[y] and not any(same_person(p, q) for p in surnames[x] for q in surnames[y]):
                        queue.append((a.idx, b.idx, round(min(s, 0.85), 3)))
                        continue
                    if x != y:
                        parent[x] = y
                        surnames[y] |= surnames[x]
                    edges.append((a.idx, b.idx))
                elif s >= 0.7:
                    queue.append((a.idx, b.idx, round(s, 3)))
    return {r.idx: root(r.idx) for r in m}, edges, queue, kept


def test_resolution_equals_one_loop(found):
    m, out = found
    roots, edges, queue, kept = one_loop(m.collect())
    assert {r.idx: r.root for r in out["roots"].collect()} == roots
    assert sorted((r.i, r.j) for r in out["edges"].collect()) == sorted(edges)
    assert sorted((r.i, r.j, pytest.approx(r.score, abs=1e-3)) for r in out["queue"].collect()) == sorted(queue)
    assert len(edges) > 20 and len(queue) > 20 and resolution.candidate_pairs(m).count() == kept
    people = resolution.identities(m, out).collect()
    assert len(people) == len(set(roots.values())) and sum(p.n_mentions for p in people) == len(roots)
    ids = [p.person_id for p in sorted(people, key=lambda p: p.root)]
    assert ids == [f"0-{i:04d}" for i in range(1, len(ids) + 1)]
    names = {r.idx: r.name or "" for r in m.collect()}
    for p in people:
        mine = [names[i] for i in sorted(names) if roots[i] == p.root]
        assert p.canonical_name == max(mine, key=len)
    stats = resolution.resolution_statistics(m, out, resolution.identities(m, out), resolution.candidate_pairs(m)).first()
    assert (stats.mentions, stats.identities, stats.auto_merges, stats.review_pairs) == (len(roots), len(people), len(edges), len(queue)) and stats.pairs_blocked_by_context >= 0


def test_a_reviewers_decisions(spark, found):
    m, out = found
    rows = {r.idx: r for r in m.collect()}
    i, j, _ = sorted((r.i, r.j, 0) for r in out["queue"].collect())[0]
    x, y = sorted((r.i, r.j) for r in out["edges"].collect())[0]
    told = [(0, 0, rows[i].entry, rows[i].id, rows[j].entry, rows[j].id, "same"), (0, 1, rows[y].entry, rows[y].id, rows[x].entry, rows[x].id, "different"), (0, 2, "no", "P0", rows[i].entry, rows[i].id, "same"), (0, 3, rows[i].entry, rows[i].id, rows[x].entry, rows[x].id, "unsure")]
    must, cannot = resolution.constraints(spark.createDataFrame(told, "volume int, pos int, entry_a string, id_a string, entry_b string, id_b string, decision string"), m)
    assert [(r.i, r.j) for r in must.collect()] == [(i, j)] and [(r.i, r.j) for r in cannot.collect()] == [(x, y)]
    again = resolution.resolve(m, must, cannot, stage=lambda df: df.cache())
    roots = {r.idx: r.root for r in again["roots"].collect()}
    assert roots[i] == roots[j] and (x, y) not in {(r.i, r.j) for r in again["edges"].collect()}
    assert (i, j) not in {(r.i, r.j) for r in again["queue"].collect()}
    flagged = {p.root for p in resolution.identities(m, again).where("needs_review").collect()}
    assert (roots[x] in flagged) == (roots[x] == roots[y])


def test_screens_show_both_sides(found):
    m, out = found
    roots = {r.idx: r.root for r in out["roots"].collect()}
    best = {}
    people = set()
    for r in out["queue"].collect():
        for a, b in ((roots[r.i], roots[r.j]), (roots[r.j], roots[r.i])):
            people.add(a)
            if a != b:
                best.setdefault(a, {})[b] = max(best.get(a, {}).get(b, 0), r.score)
    screens = {r.person: r for r in resolution.person_screens(out["queue"], m, out["roots"]).collect()}
    assert set(screens) == people
    for p, r in screens.items():
        assert r.n_candidates == len(best.get(p, {})) and r.best_score == max(best.get(p, {None: 0.0}).values())
    spread = resolution.screen_distribution(resolution.person_screens(out["queue"], m, out["roots"])).collect()
    assert sum(r.screens for r in spread) == len(people)


def test_components_of_any_graph(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randint(0, 120)}", f"n{rng.randint(0, 120)}") for _ in range(70)] + [(f"p{i}", f"p{i + 1}") for i in range(60)] + [("hub", f"q{i}") for i in range(50)] + [(None, "a"), ("self", "self")]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "source string, target string"), spark.createDataFrame([("lone",), ("p3",)], "node string")).collect()}
    assert got == {x: root(x) for x in parent} | {"lone": "lone"}


def test_graphml_is_well_formed(spark, tmp_path):
    people = spark.createDataFrame([("V-0001", "Ana <&> \"Rosa\"", 2, False, None), ("V-0002", "Blas", 1, True, "cura")], "id string, label string, mentions long, needs_review boolean, occupation string")
    people = people.select("id", "label", "mentions", "needs_review", "occupation", *[F.lit(None).cast("string").alias(k) for k in graph.NODE_ATTRIBUTES[4:]])
    edges = spark.createDataFrame([("V-0001", "spouse", "V-0002", 2, ["1-01", "1-02"])], "source string, type string, target string, weight long, entries array<string>")
    graph.write_graphml(people, edges, str(tmp_path / "g"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    root = ET.fromstring(text)
    ns = {"g": graph.GRAPHML}
    assert [n.get("id") for n in root.findall(".//g:node", ns)] == ["V-0001", "V-0002"]
    assert root.find(".//g:edge/g:data[@key='entries']", ns).text == "1-01;1-02" and len(root.findall("g:key", ns)) == 14
    rows = graph.node_rows(people).orderBy("id").collect()
    assert (rows[1].needs_review, rows[0].occupation, rows[1].occupation) == ("true", "", "cura")


def test_arrays_equal_columns(tables, monkeypatch):
    """Pairs in tiles against the same pairs scored as columns, and sums by person against the pairs."""
    monkeypatch.setattr(blocks, "CELLS", 50)
    monkeypatch.setattr(blocks, "SLICE", 200)
    m = resolution.mentions(*tables).cache()
    same = lambda df: sorted((r.i, r.j, r.score, tuple(r.reasons)) for r in df.collect())
    columns = resolution.pair_scores(resolution.candidate_pairs(m)).select(F.col("a.idx").alias("i"), F.col("b.idx").alias("j"), "score", "reasons")
    assert same(resolution.scored_pairs(m)) == same(columns)
    out = resolution.resolve(m, stage=lambda df: df.cache())
    review = {(r[0], r[1]): r for r in same(columns) if r[2] >= resolution.REVIEW}
    assert len(review) == out["edges"].count() + out["queue"].count()
    for r in out["queue"].collect():
        assert tuple(x for x in r.reasons if not x.startswith("blocked")) == review[r.i, r.j][3]
    found = resolution.people(m, screens=True).cache()
    assert {(r.idx, r.root) for r in found.collect()} == {(r.idx, r.root) for r in out["roots"].collect()}
    screens = lambda df: sorted((r.person, r.n_candidates, r.best_score) for r in df.collect())
    assert screens(found.where("n_candidates IS NOT NULL").withColumnRenamed("root", "person")) == screens(resolution.person_screens(out["queue"], m, out["roots"]))
    persons = resolution.identities(m, out)
    assert resolution.statistics_of_people(m, found, persons).collect() == resolution.resolution_statistics(m, out, persons, resolution.candidate_pairs(m)).collect()
