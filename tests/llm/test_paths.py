"""Paths of repeated windows: branches, parts of others, repeats inside a document; words are read at the source."""

import random

import numpy as np
import pyarrow as pa

from parchment.llm import repeats, substrings


def removed(rows):
    """n_removed by a plain loop over all windows; rows in their order."""
    seen, out = set(), []
    for _, text in rows:
        w, gone = (text or "").split(), set()
        for s in range(len(w) - 19):
            window = tuple(w[s : s + 20])
            gone |= set(range(s, s + 20)) if window in seen else set()
            seen.add(window)
        out.append(len(gone))
    return out


def test_branching_texts_equal_a_plain_loop(spark):
    rng = random.Random(3)
    pieces = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 90))] for _ in range(14)]
    rows = []
    for i in range(160):
        words = [x for _ in range(rng.randint(0, 6)) for x in rng.choice(pieces)[rng.choice((0, 0, 7)) :]]
        rows.append((i, " ".join(words)))
    rows += [(200, "a " * 90), (201, "b c " * 60), (202, "a " * 25 + "b c " * 20), (203, None), (204, " ".join(pieces[0] * 9))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.n_removed for r in substrings.dedup_words(docs, 3).collect()}
    assert [found[i] for i, _ in rows] == removed(rows)


def test_words_that_differ_from_the_source_stay():
    text = " ".join(f"x{i}" for i in range(30)).encode()
    own = repeats.Found(repeats.Runs(*(np.array([x]) for x in (0, 0, 11, 0, 0))), np.array([0]), np.array([0]), [])
    told = {"run": [0], "offset": [0], "n": [11], "src_gid": [5], "src_doc": [0], "src_at": [0]}
    same, other = substrings.digest(text.split(), 0, 11), substrings.digest([b"y"] * 30, 0, 11)
    assert substrings.repeats_of(own, pa.table({**told, "digest": [same]}), 1, [text]) == [[(0, 30)]]
    assert substrings.repeats_of(own, pa.table({**told, "digest": [other]}), 1, [text]) == [[]]
