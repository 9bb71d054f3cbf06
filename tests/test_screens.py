"""Screens of persons with all their candidates against a plain regrouping of the queue."""

import json

from parchment.operators import blocks, resolution

from .test_resolution import found, tables  # noqa: F401


def regrouped(queue, roots):
    """person: (mention shown, candidates as idx, score and reasons), pairs in order of their scores."""
    screens = {}
    for r in sorted(queue, key=lambda r: (-r.score, r.i, r.j)):
        for near, far in ((r.i, r.j), (r.j, r.i)):
            shown, seen, candidates = screens.setdefault(roots[near], (near, set(), []))
            if roots[far] != roots[near] and roots[far] not in seen:
                seen.add(roots[far])
                candidates.append((far, r.score, tuple(r.reasons)))
    return {p: (shown, candidates) for p, (shown, _, candidates) in screens.items()}


def test_screens_hold_every_candidate(found):  # noqa: F811
    m, out = found
    roots = {r.idx: r.root for r in out["roots"].collect()}
    want = regrouped(out["queue"].collect(), roots)
    assert any(len(c) > 1 and c[0][1] == c[1][1] for _, c in want.values()) and any(x[2][-1].startswith("blocked") for _, c in want.values() for x in c)
    made = resolution.person_screens(out["queue"], m, out["roots"]).collect()
    assert {r.person: (r.shown, [(c.idx, c.score, tuple(c.reasons)) for c in r.candidates or []]) for r in made} == want
    rows, mentions = resolution.screens(m).collect(), {r.idx: r for r in m.collect()}
    assert len(rows) == len(want)
    card = lambda x: (x.entry, x.id, x.name)
    for r in rows:
        shown, candidates = want[r.person]
        assert [(c.idx, c.score, tuple(c.reasons)) for c in r.candidates] == candidates
        assert (r.n_candidates, r.best_score) == (len(candidates), candidates[0][1] if candidates else 0.0)
        assert card(r) == card(mentions[shown]) and all(card(c) == card(mentions[c.idx]) for c in r.candidates)
        told = {k: v for k in ("occupation", "phenotype", "free", "origin") if (v := mentions[shown][k]) is not None}
        if context := mentions[shown].context:
            told["context"] = [f"{c.type}: {c.name}" for c in context]
        assert json.loads(r.detail) == told


def test_screens_of_small_tiles_and_batches(found, monkeypatch):  # noqa: F811
    """Here in the test's own process, as executors read the module anew."""
    m, _ = found
    given = blocks.dealt(m.withColumn("card", resolution.card(m)), resolution._weights(m), resolution.attribute, "volume", "block").toArrow()
    rules = resolution._weights(m), resolution._rules(), resolution.AUTO, resolution.REVIEW, resolution.YEARS

    def made():
        batches = [b for part in blocks.by_block(iter(given.to_batches()), "volume", "block") for b in blocks.block_screens(part, *rules)]
        return len(batches), [r for b in batches for r in b.to_pylist()]

    few, whole = made()
    monkeypatch.setattr(blocks, "CELLS", 10)
    monkeypatch.setattr(blocks, "SHOWN", 7)
    many, small = made()
    assert many > few and small == whole


def test_the_query_shows_candidates(spark):
    from __spark_entry__ import queries

    rows = queries()["person_screens"](spark, "/root/testdata/sf0.001").collect()
    assert rows and any(r.candidates for r in rows)
    assert all(r.n_candidates == len(r.candidates) and r.best_score == max((c.score for c in r.candidates), default=0.0) for r in rows)
