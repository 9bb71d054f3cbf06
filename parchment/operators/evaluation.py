"""Extracted records and page segmentation against gold: alignment, scores, roll-ups.

Alignment is greedy by similarity. It is decided for one entry, or one volume, at a time, in Arrow
batches; all totals after it are aggregates. Ties go to the larger gold, then the larger predicted
place. Where one side is missing, the other counts as missed or spurious in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import pair_similarity
from .relations import prf

# Attributes that are scored, and thresholds of alignment.
ATTRIBUTES = ("titles", "rank", "origin", "ethnicity", "age", "legitimate", "occupation", "phenotype", "free")
NAMES_LEAST, EVENTS_LEAST, TEXTS_LEAST, SEGMENTS_LEAST = 0.72, 0.5, 0.6, 0.75


def greedy(gold: int, pred: int, score: Callable[[int, int], float], least: float) -> list[tuple[int, int, float]]:
    """Pairs (gold, pred, score) of best scores first, each side used once."""
    scored = sorted(((s, g, p) for g in range(gold) for p in range(pred) if (s := score(g, p)) >= least), reverse=True)
    used_gold: set[int] = set()
    used_pred: set[int] = set()
    out = []
    for s, g, p in scored:
        if g not in used_gold and p not in used_pred:
            used_gold.add(g)
            used_pred.add(p)
            out.append((g, p, s))
    return out


def align_names(gold: DataFrame, pred: DataFrame, key: list[str], least: float = NAMES_LEAST) -> DataFrame:
    """key, gold_id, pred_id, score: people of the same entry aligned by name; either id is null where nobody fits.

    gold and pred: key columns, id, pos and name.
    """
    side = lambda df, name: df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "name"))).alias(name))
    both = side(gold, "g").join(side(pred, "p"), key, "full")
    fields = ", ".join(f"{k} {both.schema[k].dataType.simpleString()}" for k in key)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in range(len(batch)):
                head = [batch[k].iloc[at] for k in key]
                g, p = (list(v) if v is not None else [] for v in (batch["g"].iloc[at], batch["p"].iloc[at]))
                pairs = greedy(len(g), len(p), lambda i, j, g=g, p=p: pair_similarity(g[i]["name"] or "", p[j]["name"] or ""), least)
                rows += [(*head, g[i]["id"], p[j]["id"], s) for i, j, s in pairs]
                done_g, done_p = {i for i, _, _ in pairs}, {j for _, j, _ in pairs}
                rows += [(*head, x["id"], None, None) for i, x in enumerate(g) if i not in done_g]
                rows += [(*head, None, x["id"], None) for j, x in enumerate(p) if j not in done_p]
            yield pd.DataFrame(rows, columns=[*key, "gold_id", "pred_id", "score"])

    return both.mapInPandas(align, f"{fields}, gold_id string, pred_id string, score double")


def confusion(aligned: DataFrame, *keys: str) -> DataFrame:
    """tp, fp, fn of an alignment and its precision, recall and f1."""
    counts = aligned.groupBy(*keys).agg(
        F.count_if(F.expr("gold_id IS NOT NULL AND pred_id IS NOT NULL")).alias("tp"), F.count_if(F.expr("gold_id IS NULL")).alias("fp"), F.count_if(F.expr("pred_id IS NULL")).alias("fn")
    )
    return counts.select(*keys, "tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def attribute_rollup(pairs: DataFrame, attributes: tuple[str, ...], gold: Callable[[str], Column], pred: Callable[[str], Column]) -> DataFrame:
    """attribute, gold_count, accuracy and hallucination_rate over aligned pairs; rates are null where there is nothing to rate."""
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), gold(a).cast("string").alias("g"), pred(a).cast("string").alias("p")) for a in attributes]))
    rows = pairs.select(each.alias("x")).select("x.*")
    counts = rows.groupBy("attribute").agg(
        F.count("g").alias("gold_count"), F.count("p").alias("pred_count"), F.count_if(F.expr("g = p")).alias("correct"), F.count_if(F.expr("g IS NULL AND p IS NOT NULL")).alias("invented")
    )
    rate = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 4)
    return counts.select("attribute", "gold_count", rate("correct", "gold_count").alias("accuracy"), rate("invented", "pred_count").alias("hallucination_rate"))


def date_and_witnesses(pairs: DataFrame) -> DataFrame:
    """date_accuracy and witness precision, recall and f1 over aligned events (gold_date, pred_date, gold_witnesses, pred_witnesses).

    All are null where no gold event has a date, or neither side has a witness: what is not exercised has not failed.
    """
    none = F.array().cast("array<string>")
    g, p = F.coalesce("gold_witnesses", none), F.coalesce("pred_witnesses", none)
    sums = pairs.agg(
        F.count("gold_date").alias("dates"), F.count_if(F.expr("gold_date = pred_date")).alias("right"),
        F.coalesce(F.sum(F.size(F.array_intersect(g, p))), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.size(F.array_except(p, g))), F.lit(0)).alias("fp"), F.coalesce(F.sum(F.size(F.array_except(g, p))), F.lit(0)).alias("fn"),
    )
    seen = F.col("tp") + F.col("fp") + F.col("fn") > 0
    names = ("precision", "recall", "f1")
    scores = [F.when(seen, c).alias(f"witness_{n}") for c, n in zip(prf(F.col("tp"), F.col("fp"), F.col("fn")), names, strict=True)]
    return sums.select(F.round(F.col("right") / F.nullif(F.col("dates"), F.lit(0)), 4).alias("date_accuracy"), *scores)


def relation_scores(gold: DataFrame, pred: DataFrame, key: list[str]) -> DataFrame:
    """precision, recall and f1 of typed relations; both sides: key, source, type, target in the same names, each edge once."""
    g, p = (df.where("source IS NOT NULL AND type <> '' AND target IS NOT NULL").select(*key, "source", "type", "target").distinct() for df in (gold, pred))
    both = g.withColumn("_g", F.lit(True)).join(p.withColumn("_p", F.lit(True)), [*key, "source", "type", "target"], "full")
    counts = both.agg(F.count_if(F.expr("_g AND _p")).alias("tp"), F.count_if(F.expr("_g IS NULL")).alias("fp"), F.count_if(F.expr("_p IS NULL")).alias("fn"))
    return counts.select("tp", "fp", "fn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def named_relations(relations: DataFrame, people: DataFrame, aligned: DataFrame | None = None) -> DataFrame:
    """Relations between names: of predicted people (with ``aligned``) the gold person's name, or their own marked as predicted."""
    from ..functions.text import normalize_name

    key = ["volume", "entry"]
    names = people.select(*key, "id", normalize_name(F.col("name")).alias("name"))
    if aligned is not None:
        gold = aligned.where("pred_id IS NOT NULL").select(*key, F.col("pred_id").alias("id"), F.col("gold_name"))
        names = names.join(gold, [*key, "id"], "left").select(*key, "id", F.coalesce("gold_name", F.concat(F.lit("pred:"), "name")).alias("name"))
    at = lambda local, name: names.select(*key, F.col("id").alias(local), F.col("name").alias(name))
    ends = relations.join(at("id", "source"), [*key, "id"]).join(at("related_person", "target"), [*key, "related_person"])
    return ends.select(*key, "source", F.lower(F.trim("relationship_type")).alias("type"), "target")


def event_score(gold: dict, pred: dict) -> float:
    """0 for events of different types; half for the type, up to 0.3 for shared principals, 0.2 for the date."""
    if gold["type"] != pred["type"]:
        return 0.0
    a, b = set(gold["principals"]), set(pred["principals"])
    shared = 0.3 * len(a & b) / max(len(a | b), 1) if a & b else 0.0
    return 0.5 + shared + (0.2 if gold["date"] and gold["date"] == pred["date"] else 0.0)


def align_events(gold: DataFrame, pred: DataFrame, key: list[str], least: float = EVENTS_LEAST) -> DataFrame:
    """key, gold_id, pred_id (places) and both sides' dates and witnesses of aligned events; a side is null where nothing fits.

    gold and pred: key, pos, type, date, principals and witnesses (arrays of names).
    """
    fields = ("pos", "type", "date", "principals", "witnesses")
    side = lambda df, name: df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
    both = side(gold, "g").join(side(pred, "p"), key, "full")
    head = ", ".join(f"{k} {both.schema[k].dataType.simpleString()}" for k in key)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in range(len(batch)):
                keys = [batch[k].iloc[at] for k in key]
                g, p = (list(v) if v is not None else [] for v in (batch["g"].iloc[at], batch["p"].iloc[at]))
                pairs = greedy(len(g), len(p), lambda i, j, g=g, p=p: event_score(g[i], p[j]), least)
                take = lambda e: (str(e["pos"]), e["date"], list(e["witnesses"])) if e else (None, None, None)
                found = [(g[i], p[j]) for i, j, _ in pairs]
                found += [(x, None) for i, x in enumerate(g) if i not in {a for a, _, _ in pairs}]
                found += [(None, x) for j, x in enumerate(p) if j not in {b for _, b, _ in pairs}]
                rows += [(*keys, *take(a), *take(b)) for a, b in found]
            yield pd.DataFrame(rows, columns=[*key, "gold_id", "gold_date", "gold_witnesses", "pred_id", "pred_date", "pred_witnesses"])

    return both.mapInPandas(align, f"{head}, gold_id string, gold_date string, gold_witnesses array<string>, pred_id string, pred_date string, pred_witnesses array<string>")


def align_entries(gold: DataFrame, pred: DataFrame, least: float = TEXTS_LEAST) -> DataFrame:
    """volume, gold_entry, pred_entry: entries by id, what is left by the ratio of whole texts in lower case; null where nothing fits.

    gold and pred: volume, entry, text. Only what no id aligned is compared, a volume at a time.
    """
    kind = gold.schema["volume"].dataType.simpleString()
    same = gold.select("volume", "entry").join(pred.select("volume", "entry"), ["volume", "entry"]).distinct()
    left = lambda df: df.join(same, ["volume", "entry"], "left_anti")
    side = lambda df, name: left(df).groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("entry", F.lower(F.coalesce("text", F.lit(""))).alias("text")))).alias(name))
    rest = side(gold, "g").join(side(pred, "p"), "volume", "full")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in range(len(batch)):
                volume = batch["volume"].iloc[at]
                g, p = (list(v) if v is not None else [] for v in (batch["g"].iloc[at], batch["p"].iloc[at]))
                ratio = lambda i, j, g=g, p=p: SequenceMatcher(None, g[i]["text"], p[j]["text"]).ratio() if 2 * min(len(g[i]["text"]), len(p[j]["text"])) >= least * (len(g[i]["text"]) + len(p[j]["text"])) else 0.0
                pairs = greedy(len(g), len(p), ratio, least)
                rows += [(volume, g[i]["entry"], p[j]["entry"]) for i, j, _ in pairs]
                rows += [(volume, x["entry"], None) for i, x in enumerate(g) if i not in {a for a, _, _ in pairs}]
                rows += [(volume, None, x["entry"]) for j, x in enumerate(p) if j not in {b for _, b, _ in pairs}]
            yield pd.DataFrame(rows, columns=["volume", "gold_entry", "pred_entry"])

    aligned = rest.mapInPandas(align, f"volume {kind}, gold_entry string, pred_entry string")
    return same.select("volume", F.col("entry").alias("gold_entry"), F.col("entry").alias("pred_entry")).unionByName(aligned)


def squeezed(text: str) -> str:
    return "".join((text or "").split()).lower()


def contains(hay: str, needle: str, share: float = 0.85, shortest: int = 30) -> bool:
    """Whether most of a text stands in one piece in another; short texts say nothing."""
    if not hay or len(needle) < shortest or len(needle) > len(hay) + 40:
        return False
    return SequenceMatcher(None, hay, needle).find_longest_match(0, len(hay), 0, len(needle)).size >= share * len(needle)


def segmentation_score(refs: list[dict], preds: list[dict], least: float = SEGMENTS_LEAST) -> dict:
    """Scores of one volume's predicted records against reference records, white space and case aside.

    refs and preds: text, pages (a set, or None) and, of predictions, partial. Pairs of a page come before others; a partial
    prediction that is a piece of a reference, or holds one, is right. What is left is told apart: a prediction that covers two
    references or more is a missed split, one that covers none is junk, a reference in two predictions or more is split over.
    """
    r, p = [squeezed(x["text"]) for x in refs], [squeezed(x["text"]) for x in preds]
    scored = []
    for i, a in enumerate(r):
        for j, b in enumerate(p):
            if a and b and abs(len(a) - len(b)) <= 0.6 * max(len(a), len(b)) and (s := SequenceMatcher(None, a, b).ratio()) >= least:
                scored.append((bool(refs[i]["pages"] and refs[i]["pages"] & preds[j]["pages"]), s, i, j))
    matches: dict[int, tuple[int, float]] = {}
    used: set[int] = set()
    for _, s, i, j in sorted(scored, reverse=True):
        if i not in matches and j not in used:
            matches[i] = (j, s)
            used.add(j)
    open_r, open_p = [i for i in range(len(r)) if i not in matches], [j for j in range(len(p)) if j not in used]
    halves = 0
    for j in [j for j in open_p if preds[j].get("partial")]:
        i = next((i for i in open_r if contains(r[i], p[j]) or contains(p[j], r[i])), None)
        if i is not None:
            halves += 1
            open_r.remove(i)
            open_p.remove(j)
    covers = {j: [i for i in open_r if contains(p[j], r[i])] for j in open_p}
    merged = {j: c for j, c in covers.items() if len(c) >= 2}
    claimed = {i for c in merged.values() for i in c}
    split = [i for i in open_r if i not in claimed and sum(contains(r[i], p[j]) for j in open_p) >= 2]
    right = len(matches) + halves
    recall, precision = right / len(r) if r else 1.0, right / len(p) if p else 1.0
    somewhere = right + sum(any(contains(b, r[i], 0.8) for b in p) for i in open_r)
    return {
        "reference": len(r), "predicted": len(p), "matched": len(matches), "boundary_partials": halves, "recall": round(recall, 4), "precision": round(precision, 4),
        "f1": round(2 * precision * recall / (precision + recall), 4) if precision + recall else 0.0, "coverage_recall": round(somewhere / len(r), 4) if r else 1.0,
        "mean_sim": round(sum(round(s, 3) for _, s in matches.values()) / len(matches), 4) if matches else 0.0, "missed_splits": len(merged), "over_splits": len(split),
        "junk": sum(not c for c in covers.values()), "lost": len(open_r) - len(claimed) - len(split),
    }


SCORES = "reference bigint, predicted bigint, matched bigint, boundary_partials bigint, recall double, precision double, f1 double, coverage_recall double, mean_sim double, missed_splits bigint, over_splits bigint, junk bigint, lost bigint"


def score_segmentation(refs: DataFrame, preds: DataFrame) -> DataFrame:
    """A row a volume of ``segmentation_score``. refs: volume, text, page; preds: volume, text, pages (array), partial."""
    kind = refs.schema["volume"].dataType.simpleString()
    a = refs.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("r"))
    b = preds.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("pages", "text", "partial"))).alias("p"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for volume, r, p in zip(batch["volume"], batch["r"], batch["p"], strict=True):
                known = [{"text": x["text"], "pages": {x["page"]} if x["page"] is not None else None} for x in (r if r is not None else [])]
                found = [{"text": x["text"], "pages": set(x["pages"]), "partial": x["partial"]} for x in (p if p is not None else [])]
                out.append({"volume": volume} | segmentation_score(known, found))
            yield pd.DataFrame(out)

    return a.join(b, "volume", "full").mapInPandas(score, f"volume {kind}, {SCORES}")


def margin_numbers(text: Column) -> Column:
    """Numbers of 1 to 300 that stand alone on a line, or with a dot before its text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    number = lambda x: F.coalesce(F.nullif(F.regexp_extract(x, r"^\s*([0-9]{1,3})\.{0,2}\s*$", 1), F.lit("")), F.nullif(F.regexp_extract(x, r"^\s*([0-9]{1,3})\.{1,2}\s+\S", 1), F.lit(""))).cast("int")
    return F.filter(F.transform(lines, number), lambda n: n.between(1, 300))


def margin_check(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """For each page, the numbers in its margin, the records that start on it (starts: volume, page_no, records) and whether they agree."""
    counted = pages.select("volume", "page_no", F.size(margin_numbers(F.col("text"))).cast("bigint").alias("expected"))
    both = counted.join(starts, ["volume", "page_no"], "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return both.withColumn("ok", F.col("expected") == F.col("records"))


def correction_score(judged: DataFrame, missing_pages: DataFrame) -> DataFrame:
    """Precision and a lower bound of recall of each volume from a reviewer's verdicts.

    judged: volume, entry, verdict (correct, merge, split, bad or null); missing_pages: volume and page of a start that was missed.
    """
    is_ = lambda v: F.count_if(F.col("verdict") == v)
    counts = judged.groupBy("volume").agg(
        F.count(F.lit(1)).alias("predicted_entries"), F.count("verdict").alias("judged"), is_("correct").alias("exact_correct"), is_("merge").alias("over_splits_merge"), is_("split").alias("under_splits"), is_("bad").alias("wrong")
    )
    missed = missing_pages.groupBy("volume").agg(F.count(F.lit(1)).alias("pages_with_missing_starts"))
    both = counts.join(missed, "volume", "left").withColumn("pages_with_missing_starts", F.coalesce("pages_with_missing_starts", F.lit(0)))
    found, lost = F.col("exact_correct") + F.col("under_splits"), F.col("under_splits") + F.col("pages_with_missing_starts")
    return both.withColumns({
        "false_positive_boundaries": F.col("over_splits_merge") + F.col("wrong"),
        "precision": F.round(F.col("exact_correct") / F.nullif(F.col("judged"), F.lit(0)), 3), "recall_approx": F.round(found / F.nullif(found + lost, F.lit(0)), 3),
    })


def review_slice(segmented: DataFrame, most: int = 12) -> DataFrame:
    """Pages of each volume for a review sheet: up to ``most``, from the first one with records on."""
    from pyspark.sql import Window as W

    w = W.partitionBy("volume").orderBy("page_no")
    flags = segmented.select("volume", "page_no", (F.size("entries") > 0).cast("int").alias("_h"))
    begun = flags.withColumn("_b", F.max("_h").over(w.rowsBetween(W.unboundedPreceding, 0))).where("_b = 1")
    return begun.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).select("volume", "page_no")

