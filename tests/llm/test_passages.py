"""Passages of over 50 words that several documents share, in otherwise distinct texts, and rows of any shape."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from parchment.llm import suffixes
from parchment.llm.common import stage_table


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def plain(texts, window):
    """Each text without the bytes of strings of ``window`` bytes that start at two places."""
    data = [t.encode() for t in texts]
    seen = Counter(t[i : i + window] for t in data for i in range(len(t) - window + 1))
    masks = [np.zeros(len(t), bool) for t in data]
    for t, mask in zip(data, masks, strict=True):
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                mask[i : i + window] = True
    return [bytes(b for b, gone in zip(t, m, strict=True) if not gone) for t, m in zip(data, masks, strict=True)], masks


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    passages = [words(rng, n) for n in range(51, 61)]
    texts = [words(rng, rng.randint(60, 300)) for _ in range(60)]
    for i in range(30):
        texts[i] = f"{texts[i]} {passages[i % 10]} {words(rng, 70)}"
    return passages, texts


def test_planted_passages_go_and_clean_documents_stay(spark, planted):
    passages, texts = planted
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r for r in dict(P.STAGES)["suffix_array_dedup"](spark, docs, "").collect()}
    want, _ = plain(texts, suffixes.PASSAGE)
    for i, text in enumerate(texts):
        assert got[i].text == want[i].decode("utf-8", "ignore") and got[i].n_chars == len(got[i].text)
        if i < 30:
            assert passages[i % 10] not in got[i].text
        else:
            assert got[i].text == text


def test_bytes_in_passages_are_counted_beside_those_removed(spark, planted):
    _, texts = planted
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in suffixes.dedup_bytes(docs, 3, passage=suffixes.PASSAGE).collect()}
    _, short = plain(texts, suffixes.PASSAGE)
    _, long = plain(texts, suffixes.WINDOW)
    for i in range(len(texts)):
        assert found[i].n_in_passages == short[i].sum() and found[i].n_removed == long[i].sum()


def test_other_columns_keep_their_names_and_values(spark):
    schema = "doc_id bigint, text string, kept string, n_removed int, n_bytes string, carried struct<x:int>, gid string, tie date, kind array<int>"
    rows = [(1, "a", "k", 1, "b", (1,), "g", None, [1]), (None, None, None, None, None, None, None, None, None), (1, "a", "k2", 2, "b", None, "g", None, [])]
    docs = spark.createDataFrame(rows, schema)
    out = suffixes.dedup_texts(docs)
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(repr(type(r)(**{**r.asDict(), "text": r.text or ""})) if r.text is None else repr(r) for r in docs.collect())
    assert stage_table(suffixes.dedup_texts(docs.limit(0))).count() == 0


def test_megabyte_texts_and_many_rows_without_an_id(spark):
    rng = random.Random(5)
    big = words(rng, 200_000)
    rows = [(1, big), (2, big[300_000:700_000]), *[(None, words(rng, 80)) for _ in range(200)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in suffixes.dedup_bytes(docs, 4).collect() if r.doc_id}
    assert found[2].n_removed == 400_000 and found[1].n_removed == 400_000 and found[1].n_spans == 1
    assert suffixes.dedup_bytes(docs, 4).where("doc_id is null and n_removed = 0").count() == 200
