import json

from parchment.sources import pages


def test_markdown_pages(spark, tmp_path):
    (tmp_path / "a.md").write_text("# Book\n\n### one.jpg\n- **image_caption**: first\n- **transcription**:\n  line a\n  line b\n\n### two.jpg\n- **image_caption**:\n- **transcription**:\n  line c\n")
    (tmp_path / "b.md").write_text("### three.jpg\n- **image_caption**: x\n- **transcription**:\n")
    got = sorted(map(tuple, pages.read_markdown(spark, str(tmp_path)).collect()))
    assert got == [("one.jpg", "first", "line a\nline b"), ("three.jpg", "x", ""), ("two.jpg", "", "line c")]


def test_items_and_sinks(spark, tmp_path):
    items = [{"title": "t", "images": [{"file": "a", "transcription": "x\ny"}, {"file": "b", "transcription": 'say "z"'}]}, {"title": "none", "images": []}]
    (tmp_path / "v.json").write_text(json.dumps(items))
    rows = pages.read_items(spark, str(tmp_path / "v.json")).select("title", "page", "file", "transcription")
    want = [("t", 1, "a", "x\ny"), ("t", 2, "b", 'say "z"')]
    assert sorted(map(tuple, rows.collect())) == want
    pages.write_jsonl(rows, str(tmp_path / "j"))
    assert sorted(map(tuple, spark.read.schema(rows.schema).json(str(tmp_path / "j")).collect())) == want
    pages.write_csv(rows, str(tmp_path / "c"))
    assert sorted(map(tuple, spark.read.schema(rows.schema).csv(str(tmp_path / "c"), header=True, escape='"', multiLine=True).collect())) == want
