"""Near copies over whole texts against plain loops."""

import random
import re
from difflib import SequenceMatcher

import pytest

from parchment.functions.names import same_person
from parchment.operators import ratios
from parchment.operators.ratios import common_at_most, near_copies_by_ratio
from parchment.operators.relations import near_copies


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    make = lambda n: [rng.choice(vocab) + (f" {rng.randint(0, 9)}," if k % 40 == 0 else "") for k in range(n)]
    base, opening = make(500), make(200)
    changed = [*base[:9], "changed", *base[10:]]
    texts = [
        (" ".join(base), None), (" ".join(changed), "Maria"), (" \n".join(base).upper(), "María Rosa"), (" ".join(opening + make(300)), None), (" ".join(opening + make(300)), None),
        (" ".join(base), "Juan"), (" ".join(base[:300]), None), (None, None), ("", None), (" ".join(base[:340]), "Juana"), ("kurz", None), ("Kurz ", None), ("kürz", None), ("aaaa" * 90, None), ("aaaa" * 90, None),
    ]
    return [(i, "s", t, p) for i, (t, p) in enumerate(texts)] + [(None, None, "x y", None), (1, None, "x  y", None), (1, None, "x yz", "Ana")]


def test_whole_texts_are_compared(spark, rows):
    found = {(r.doc_id, r.other) for r in near_copies(spark.createDataFrame(rows, "doc_id long, source string, text string, p string").where("doc_id IS NOT NULL AND source = 's'"), "source", "doc_id", "text").collect()}
    assert found == {(0, 2), (2, 5), (10, 11), (13, 14)}  # 3 and 4 share more than 800 characters only


@pytest.mark.parametrize(("block", "autojunk"), [(1, True), (3, True), (64, True), (64, False)])
def test_ratio_equals_a_plain_loop(spark, rows, block, autojunk, monkeypatch):
    monkeypatch.setattr(ratios, "BLOCK", block)
    want = []
    for source in ("s", None):
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, r[2] or ""))
        t = [re.sub(r"\s+", " ", r[2] or "").strip().lower() for r in mine]
        for i in range(len(t)):
            for j in range(i + 1, min(i + 5, len(t))):
                if not t[i] or not t[j] or abs(len(t[i]) - len(t[j])) > 0.35 * max(len(t[i]), len(t[j])):
                    continue
                sim = 1.0 if t[i] == t[j] else SequenceMatcher(None, t[i], t[j], autojunk).ratio()
                same = same_person(mine[i][3], mine[j][3])
                if sim >= 0.75 and same is not False:
                    want.append((source, mine[i][0], mine[j][0], round(sim, 3), "confirmed" if same else "unconfirmed(no principal)"))
    found = near_copies_by_ratio(spark.createDataFrame(rows, "doc_id long, source string, text string, p string"), "source", "doc_id", "text", "p", autojunk=autojunk)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
    pairs = {(w[1], w[2]): w[4] for w in want if w[0]}
    assert pairs[0, 1].startswith("unconfirmed") and pairs[1, 2] == "confirmed" and (2, 5) not in pairs and (3, 4) not in pairs and (0, 4) not in pairs


def test_bound_is_the_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("01ab\n") for _ in range(rng.randint(1, 30))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert common_at_most(a, b, 0) == row[-1] >= sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())


def test_names():
    assert same_person("Don Juan", None) is None and same_person("Rachael", "rachael macqueen") and same_person("Vicente Bibes", "Bicente Vives")
    assert same_person("Hanna MacQueen", "Rachael MacQueen") is False and same_person("Don", "Juan") is False
