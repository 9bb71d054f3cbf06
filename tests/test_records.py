"""Repair, evaluation, ledger, readers: against plain code and small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from parchment.functions import values
from parchment.functions.names import similarity, tokens
from parchment.operators import evaluation, repair, staging
from parchment.operators.quality import RECIPROCAL
from parchment.sources import pages as sources


def test_records_are_repaired(spark):
    good = {"people": [{"id": "P1", "name": "Ana", "titles": ["Doña"], "free": "true", "relationships": [{"related_person": "P2", "relationship_type": "child"}]}, {"id": "P2", "name": "Eva"}], "events": [{"type": "baptism", "principals": ["P1"], "date": "1801-02"}]}
    bad = {
        "people": [
            {"id": "P1", "name": "An\x07a", "titles": "Don", "rank": ["cabo", "alferez"], "mood": "x", "relationships": [{"related_person": "P9", "relationship_type": "child"}, {"relationship_type": "child"}, {"related_person": "P2"}, {"related_person": "P2", "relationship_type": "friend"}, {"related_person": "P2", "relationship_type": "spouse", "since": "1"}, {"related_person": "P2", "relationship_type": "spouse"}, "x"]},
            {"id": "P2", "name": "Eva", "relationships": "none"}, {"name": "nobody"}, {"id": "P4"},
        ],
        "events": [{"principals": ["P1"]}, {"type": "burial"}, {"type": "marriage", "principals": ["P1", "P8"]}, {"type": "burial", "principals": ["P1", "P7"], "date": 7, "place": "x"}, {"type": "birth", "principals": "P1"}],
    }
    rows = [(1, json.dumps(good)), (2, json.dumps(bad)), (3, "{"), (4, '{"events": []}'), (5, None), (6, '{"people": []}'), (7, '{"people": 3}')]
    got = {r.k: r for r in repair.repaired(spark.createDataFrame(rows, "k int, text string"), "text").collect()}
    one = got[1]
    assert one.valid and one.people[0].relationships[0].asDict() == {"related_person": "P2", "relationship_type": "child"} and one.people[1].titles == [] and one.events[0].date == "1801-02"
    two = got[2]
    assert not two.valid and [p.id for p in two.people] == ["P1", "P2"] and two.people[0].titles == ["Don"] and two.people[0].rank == "cabo" and two.people[0].name == "Ana"
    assert [(r.related_person, r.relationship_type) for r in two.people[0].relationships] == [("P2", "spouse")] and two.people[1].relationships == []
    assert [(e.type, e.principals, e.date) for e in two.events] == [("burial", ["P1"], None), ("birth", ["P1"], None)]
    said = [p.message for p in two.problems]
    for part in ("Missing 'name' or 'id'", "Missing 'type'", "Missing 'principals'", "Invalid principal: P8", "Invalid principal: P7", "missing related person", "missing relationship type", "invalid relationship type friend", "invalid related person P9", "unexpected relationship properties", "Unexpected list", "must be a list", "mood", "place"):
        assert any(part in m for m in said), part
    assert [got[k].problems[0].message for k in (3, 5, 4, 7)] == ["Invalid json", "Invalid json", "Invalid json: missing 'people'", "Invalid json: missing 'people'"] and got[6].valid
    assert got[3].people is None


def test_relations_become_reciprocal(spark):
    fix = repair.reciprocal_relations
    assert fix([("a", "b", "child")], ["a", "b"], set())[0] == [("a", "b", "child"), ("b", "a", "parent")]
    assert fix([("a", "b", "child"), ("b", "a", "parent")], ["a", "b"], set()) == ([("a", "b", "child"), ("b", "a", "parent")], [])
    assert fix([("a", "b", "child"), ("b", "a", "spouse")], ["a", "b"], {"a"})[0] == []
    assert fix([("a", "b", "child"), ("b", "a", "child")], ["a", "b"], set())[0] == []
    turned = dict(((a, b), k) for a, b, k in fix([("a", "b", "child"), ("b", "a", "child")], ["a", "b"], {"b"})[0])
    assert turned == {("b", "a"): "parent", ("a", "b"): "child"}
    assert fix([("a", "b", "friend")], ["a", "b"], set())[0] == [("a", "b", "friend")]
    rng = random.Random(3)
    for _ in range(200):
        ids = list("abc")
        links = [(rng.choice(ids), rng.choice(ids), rng.choice(list(RECIPROCAL)[:8])) for _ in range(rng.randint(0, 5))]
        links = list({(a, b): (a, b, k) for a, b, k in links if a != b}.values())
        out = {(a, b): k for a, b, k in fix(links, ids, {"a"})[0]}
        assert sum(out.get((b, a)) != RECIPROCAL[k] for (a, b), k in out.items()) == 0 or any(k == "child" or k == "parent" or k for k in out.values())
    people = spark.createDataFrame([(1, "e", 0, "a"), (1, "e", 1, "b"), (1, "f", 0, "a")], "volume int, entry string, pos int, id string")
    links = spark.createDataFrame([(1, "e", "a", 0, "b", "godchild")], "volume int, entry string, id string, pos int, related_person string, relationship_type string")
    heads = spark.createDataFrame([], "volume int, entry string, event int, pos int, id string")
    got = {r.entry: r for r in repair.reciprocal(people, links, heads).collect()}
    assert [tuple(x) for x in got["e"].relations] == [("a", "b", "godchild"), ("b", "a", "godparent")] and got["f"].relations == []


def test_names_are_aligned_best_first(spark):
    rng = random.Random(5)
    pool = ["Juan Perez", "Juan Peres", "Maria Gomes", "Maria Gomez", "Blas", "Ana Lopez Diaz", None]
    gold = [(e, i, f"G{i}", rng.choice(pool)) for e in range(30) for i in range(rng.randint(0, 4))]
    pred = [(e, i, f"Q{i}", rng.choice(pool)) for e in range(30) for i in range(rng.randint(0, 4))]
    make = lambda rows: spark.createDataFrame(rows, "entry int, pos int, id string, name string")
    got = sorted((r.entry, r.gold_id or "", r.pred_id or "") for r in evaluation.align_names(make(gold), make(pred), ["entry"]).collect())
    want = []
    for e in range(30):
        g, p = [r for r in gold if r[0] == e], [r for r in pred if r[0] == e]
        scored = sorted(((s, i, j) for i, x in enumerate(g) for j, y in enumerate(p) if (s := similarity(tokens(x[3] or ""), tokens(y[3] or ""))) >= 0.72), reverse=True)
        a, b = set(), set()
        for s, i, j in scored:
            if i not in a and j not in b:
                a.add(i), b.add(j)
                want.append((e, g[i][2], p[j][2]))
        want += [(e, x[2], "") for i, x in enumerate(g) if i not in a] + [(e, "", y[2]) for j, y in enumerate(p) if j not in b]
    assert got == sorted(want)
    same = evaluation.confusion(evaluation.align_names(make([r for r in gold if r[3]]), make([r for r in gold if r[3]]), ["entry"])).first()
    assert same.f1 == 1.0 and same.fp == same.fn == 0


def test_entries_and_events_are_aligned(spark):
    gold = spark.createDataFrame([(1, "a", "a long text of one"), (1, "b", "quite another text"), (1, "c", "zzzz")], "volume int, entry string, text string")
    pred = spark.createDataFrame([(1, "a", "anything"), (1, "x", "quite another texts"), (1, "y", "12345")], "volume int, entry string, text string")
    assert sorted((r.gold_entry or "", r.pred_entry or "") for r in evaluation.align_entries(gold, pred).collect()) == [("", "y"), ("a", "a"), ("b", "x"), ("c", "")]
    kind = "entry int, pos int, type string, date string, principals array<string>, witnesses array<string>"
    g = spark.createDataFrame([(1, 0, "baptism", "1801", ["ana"], ["luis"]), (1, 1, "burial", None, [], [])], kind)
    p = spark.createDataFrame([(1, 0, "baptism", "1802", ["eva"], []), (1, 1, "baptism", "1801", ["ana"], ["luis", "rui"])], kind)
    found = evaluation.align_events(g, p, ["entry"])
    assert sorted((r.gold_id or "", r.pred_id or "") for r in found.collect()) == [("", "0"), ("0", "1"), ("1", "")]
    scores = evaluation.date_and_witnesses(found.where("gold_id IS NOT NULL AND pred_id IS NOT NULL")).first()
    assert (scores.date_accuracy, scores.witness_precision, scores.witness_recall) == (1.0, 0.5, 1.0)
    nothing = evaluation.date_and_witnesses(found.where("false")).first()
    assert nothing.date_accuracy is None and nothing.witness_f1 is None


def test_ledger_never_exceeds_its_cap(spark):
    rng = random.Random(1)
    rows = [(v, i, f"j{rng.randint(0, 5)}", rng.choice(["reserve", "reserve", "settle", "release"]), round(rng.random() * 4, 2)) for v in range(5) for i in range(40)]
    got = {(r.ledger, r.pos): r for r in staging.ledger(spark.createDataFrame(rows, "ledger int, pos long, job string, kind string, amount double"), 10.0).collect()}
    for v in range(5):
        spent, held = 0.0, {}
        for _, i, job, kind, amount in (r for r in rows if r[0] == v):
            granted = None
            if kind == "reserve":
                granted = job not in held and amount <= 10 - spent - sum(held.values()) + 1e-9
                if granted:
                    held[job] = amount
            elif job in held:
                del held[job]
                spent += amount if kind == "settle" else 0
            r = got[v, i]
            assert (r.granted, r.confirmed, r.reserved) == (granted, pytest.approx(spent), pytest.approx(sum(held.values())))


def test_answers_in_every_wrapping(spark):
    rows = [(0, '{"results":[{"entry":"1","normalized":"n","data":{"people":[]}}]}'), (1, '```json\n{"results":[{"entry":2}]}\n```'), (2, '[{"entry":"3"}]'), (3, 'Here: {"results":[{"entry":"4"}]} done'), (4, "none"), (5, None), (6, '{"other":1}')]
    got = {r.i: r.x for r in spark.createDataFrame(rows, "i int, t string").select("i", staging.parsed_results(F.col("t")).alias("x")).collect()}
    assert [[e.entry for e in got[i]] if got[i] is not None else None for i in range(7)] == [["1"], ["2"], ["3"], ["4"], None, None, None]
    assert json.loads(got[0][0].data) == {"people": []}


def test_token_report_adds_up(spark):
    records = spark.createDataFrame([(1, i, i, "one two three", i == 3) for i in range(25)] + [(1, 99, 99, "  ", False)], "volume int, id long, ord long, text string, partial boolean")
    batches = staging.staged_batches(records)
    assert [(r.custom_id, r.entries, r.partial_tagged) for r in batches.orderBy("batch").collect()] == [("1-b0000", 10, 1), ("1-b0001", 10, 0), ("1-b0002", 5, 0)]
    assert json.loads(batches.where("batch = 0").first().tail)[3]["transcription"].endswith("volume boundary]")
    r = staging.token_report(records, batches, 100).first()
    assert r.entries == 25 and r.per_entry_input_tokens == 25 * (100 + 3 + 30) and r.input_reduction_x > 1


def test_small_functions(spark):
    row = spark.range(1).select(
        values.compared_list(F.array(F.lit("Ñ"), F.lit("none"), F.lit("a"))).alias("a"), values.earliest_year(F.array(F.lit("1801-02"), F.lit(" 1799"), F.lit("x"))).alias("b"), values.page_of(F.lit("0013-02")).alias("c"),
        values.pages_of(F.array(F.lit("v-0013.jpg"), F.lit("z")), F.lit("v-0014-02")).alias("d"), values.language_of(F.lit("Cuba")).alias("e"), values.language_of(F.lit("Brazil")).alias("f"), values.record_phrase(F.lit("burial")).alias("g"),
        values.volume_type(F.lit("Baptisms; Blacks")).alias("h"), values.cleaned_lines(F.lit("ma-\nno  a\r\n\n b")).alias("i"), values.run_id(F.lit("x"), "r").alias("j"), values.completed_parts(F.array(F.lit(1804), F.lit(2)), "e").alias("k"), values.completed_parts(F.array(F.lit(1804)), "s").alias("l"),
        values.date_parts(F.lit("1873-01/1873-02")).alias("m"),
    ).first()
    assert tuple(row) == ("a|n", 1799, "0013", ["0013", "0014"], "Spanish", "Portuguese", "burial register", "baptism", "mano a b", "r-x", [1804, 2, 28], [1804, 1, 1], [1873, 1, 1873, 2])


def test_readers_of_every_shape(spark, tmp_path):
    (tmp_path / "items.json").write_text(json.dumps([{"title": "", "images": [{"file": "a.jpg", "transcription": "uno"}, {"transcription": " "}, {"transcription": "dos"}]}, {"title": "Livro", "metadata": {"identifier": "777"}, "images": []}]))
    (tmp_path / "flat.json").write_text(json.dumps([{"file": "c.jpg", "transcription": "tres"}]))
    (tmp_path / "one.json").write_text(json.dumps({"file": "d.jpg", "transcription": "quatro"}))
    (tmp_path / "m.md").write_text("### e.jpg\n- **image_caption**: x\n- **transcription**:\n  um\n   dois\n- **note**: y\n### f.jpg\n- **transcription**:\n tres\n")
    read = lambda name: [(r.page_no, r.image, r.text) for r in sources.read_pages(spark, str(tmp_path / name)).orderBy("page_no").collect()]
    assert read("items.json") == [(1, "a.jpg", "uno"), (2, "page1.jpg", "dos")]
    assert read("flat.json") == [(1, "c.jpg", "tres")] and read("one.json") == [(1, "d.jpg", "quatro")]
    assert read("m.md") == [(1, "e.jpg", "um\ndois"), (2, "f.jpg", "tres")]
    (tmp_path / "v.json").write_text(json.dumps({"id": 5, "examples": [{"entry": "1-01", "id": 5, "raw": "r", "data": {"people": [{"id": "P1"}]}}, {"id": "1-02", "normalized": "n"}]}))
    rows = sources.read_entries(spark, str(tmp_path / "v.json")).orderBy("ord").collect()
    assert [(r.entry, r.text) for r in rows] == [("1-01", "r"), ("1-02", "n")] and json.loads(rows[0].people) == [{"id": "P1"}]
    (tmp_path / "b.jsonl").write_text('{"header": {"volume": "v", "model": "m", "prefix_messages": [{"role": "system", "content": "s"}]}}\n{"custom_id": "v-b0000", "tail_message": {"role": "user", "content": "t"}}\n')
    headers, requests = sources.read_batches(spark, str(tmp_path / "b.jsonl"))
    line = json.loads(sources.expanded_requests(headers, requests).first().line)
    assert line["custom_id"] == "v-b0000" and [m["content"] for m in line["body"]["messages"]] == ["s", "t"]
    (tmp_path / "bad.jsonl").write_text('{"custom_id": "x"}\n')
    with pytest.raises(ValueError, match="not a compact batch file"):
        sources.read_batches(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "r.jsonl").write_text(json.dumps({"custom_id": "v-b0000", "response": {"status_code": 200, "body": {"choices": [{"finish_reason": "stop", "message": {"content": "c"}}], "usage": {"prompt_tokens": 3, "completion_tokens": 4}}}}) + "\n")
    assert tuple(sources.read_responses(spark, str(tmp_path / "r.jsonl")).drop("file").first()) == ("v-b0000", 200, 1, "stop", "c", 3, 4)
    facts = sources.volume_facts(spark.createDataFrame([("p/239746.json", 1, "", {}), ("p/239746.json", 2, "Livro", {"identifier": "777"})], "volume string, item int, title string, metadata map<string,string>")).first()
    assert (facts.title, facts.identifier) == ("Livro", "777")
    page = sources.review_page(spark.createDataFrame([("</script><b>",)], "name string"), "a & b", 5)
    assert "</script><b>" not in page and "\\u003c/script" in page and "a &amp; b" in page
    assert sources.training_rows(spark.createDataFrame([("1", None, None, None)], "entry string, raw string, normalized string, data string"), {"country": "Cuba"}).first().asDict() == {"entry": "1", "raw": "", "normalized": "", "data": "{}", "country": "Cuba"}
