"""Records of register pages: cut out page by page, joined over page breaks, numbered.

Pages are read one by one in Arrow batches. All that looks beyond a page is windows over narrow
rows (volume, page, flags); texts meet their neighbours only where a record runs over a page break.

Columns of pages: volume, page_no, image, text. Null texts are blank pages; a null volume is a volume.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.lines import closes, flowed, kind_of_page, reflow, tagged

# The shortest record or continuation, the least text before a dated line splits an open record.
SHORTEST, SPLIT = 25, 150
#: A page below this confidence needs another look.
TRUSTED = 0.7
IMAGE_TYPE = r"(?i)\.(jpe?g|png|tiff?)$"
PAGE = "entries array<struct<text:string,partial:boolean>>, leading string, short_leading string, leading_closes boolean, dropped array<string>, page_type string"


def cut(text: str, split: int = SPLIT) -> dict:
    """The records of one page, what stands before the first of them, and scraps."""
    kind = kind_of_page(text)
    page: dict = {"entries": [], "leading": None, "short_leading": None, "leading_closes": False, "dropped": [], "page_type": kind if kind in ("index", "error") else None}
    if page["page_type"]:
        return page
    entries, leading, held = page["entries"], [], []
    inside = closed = False

    def finish(partial: bool) -> None:
        nonlocal closed
        body = flowed(held)
        if len(body) >= SHORTEST:
            entries.append({"text": body, "partial": partial})
        elif body:
            page["dropped"].append(body)
        held.clear()
        closed = False

    for tag, line in tagged(text):
        if tag in ("opening", "strong"):
            if not inside or tag == "strong" and (closed or len(flowed(held)) >= split):
                finish(False)
            inside = True
            held.append(line)
        elif not inside and (tag == "margin" or not entries):
            if tag != "margin":
                leading.append(line)
        else:
            held.append(line)
            closed |= tag == "closing"
            if tag == "signature" and closed:
                finish(False)
                inside = False
    if held:
        finish(not closed)
    first = flowed(leading)
    page["leading_closes"] = closes(first)
    if len(first) >= SHORTEST:
        page["leading"] = first
    elif first:
        page["short_leading"] = first
        page["dropped"].append(first)
    return page


def page_records(text: Column) -> Column:
    """The records of each page by itself, as ``cut`` finds them, in a struct; of pages that cannot open one, as of a blank page.

    A record opens with a date, which has the word "de"; a line break may cut it, with a - or = beside the break.
    """
    may_open = text.rlike(r"(?iU)[\s\x1c-\x1f]de[\s\x1c-\x1f]|[-=][\s\x1c-\x1f]|[\s\x1c-\x1f][-=]")
    entry = pa.struct([("text", pa.string()), ("partial", pa.bool_())])
    kinds = {"entries": pa.list_(entry), "leading_closes": pa.bool_(), "dropped": pa.list_(pa.string())}
    names = ("entries", "leading", "short_leading", "leading_closes", "dropped", "page_type")
    page = pa.struct([(n, kinds.get(n, pa.string())) for n in names])

    def found(texts: pa.Array) -> pa.Array:
        return pa.array([cut(t or "") for t in texts.to_pylist()], page)

    return F.arrow_udf(found, PAGE)(F.when(may_open, text))


def confidence(entries: Column, leading: Column, text: Column, kind: Column) -> Column:
    """How far the records of a page can be trusted, from 0 to 1; short complete and very long ones speak against it."""
    count = lambda f: F.size(F.filter(entries, f))
    short = count(lambda e: (F.length(e["text"]) < 120) & ~e["partial"])
    long = count(lambda e: F.length(e["text"]) > 3500) + F.when(F.length(leading) > 2000, 1).otherwise(0)
    near_blank = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")) < 120
    score = F.greatest(F.lit(0.0), F.round(F.lit(1.0) - 0.15 * short - 0.2 * long, 3))
    return F.when(kind == "index", 0.85).when(kind == "error", 0.0).when(F.size(entries) == 0, F.when(near_blank, 0.9).otherwise(0.45)).otherwise(score)


def segment_pages(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    """pages with entries, leading (text before the first record), short_leading, leading_closes, dropped, page_type and confidence."""
    schema = f"volume {pages.schema['volume'].dataType.simpleString()}, page_no bigint, image string, text string, {PAGE}"

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cut(t or "", split) for t in batch.column("text").to_pylist()]
            columns = {n: batch.column(n) for n in ("volume", "page_no", "image", "text")}
            columns["entries"] = pa.array([p["entries"] for p in found], pa.list_(pa.struct([("text", pa.string()), ("partial", pa.bool_())])))
            columns["dropped"] = pa.array([p["dropped"] for p in found], pa.list_(pa.string()))
            columns |= {n: pa.array([p[n] for p in found], pa.bool_() if n == "leading_closes" else pa.string()) for n in ("leading", "short_leading", "leading_closes", "page_type")}
            yield pa.RecordBatch.from_pydict({n: columns[n] for n in ("volume", "page_no", "image", "text", "entries", "leading", "short_leading", "leading_closes", "dropped", "page_type")})

    rows = pages.select("volume", F.col("page_no").cast("bigint").alias("page_no"), F.col("image").cast("string").alias("image"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut_batches, schema).withColumn("confidence", confidence(F.col("entries"), F.col("leading"), F.col("text"), F.col("page_type")))


def _page_flow(segmented: DataFrame) -> DataFrame:
    """For each page, narrow rows: run (pages with records before it), head, and whether its first text joins the record left open.

    Pages without records hand an open record on, so that a run is one page with records and the pages up to the next such one.
    """
    w = W.partitionBy("volume").orderBy("page_no")
    flags = segmented.select(
        "volume", "page_no",
        (F.size("entries") > 0).alias("has"), F.col("leading").isNotNull().alias("long"), (F.col("leading").isNotNull() | F.col("short_leading").isNotNull()).alias("any"), "leading_closes", "page_type",
        F.coalesce(F.try_element_at("entries", F.lit(-1))["partial"], F.lit(False)).alias("tail_open"),
    )
    runs = flags.withColumn("run", F.coalesce(F.sum(F.col("has").cast("bigint")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    tail = F.max_by("tail_open", F.when(F.col("has"), F.col("page_no"))).over(w.rowsBetween(W.unboundedPreceding, -1))
    in_run = W.partitionBy("volume", "run").orderBy("page_no").rowsBetween(W.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.col("any") & F.col("leading_closes")).over(in_run), F.lit(False))
    runs = runs.withColumn("tail", F.coalesce(tail, F.lit(False)))
    return runs.withColumn("joins", F.col("any") & (F.col("run") > 0) & F.col("tail") & ~ended)


def _numbered(stem: Column, n: Column) -> Column:
    """stem-01, stem-02 and so on, with more digits where they are needed."""
    digits = n.cast("string")
    return F.concat(stem, F.lit("-"), F.lpad(digits, F.greatest(F.lit(2), F.length(digits)), F.lit("0")))


def _stem(image: Column) -> Column:
    return F.regexp_replace(F.coalesce(image, F.lit("")), IMAGE_TYPE, "")


def _same_page(a: str, b: str) -> Column:
    return F.col(f"{a}.volume").eqNullSafe(F.col(f"{b}.volume")) & (F.col(f"{a}.page_no") == F.col(f"{b}.page_no"))


def stitch(segmented: DataFrame) -> DataFrame:
    """Records of volumes in order: volume, page_no and seq (place on it), id, text, images, last_page, partial, orphan.

    Text at a page's top joins the record that an earlier page left open, until a closing formula or
    signature ends it; without one it is an orphan record. partial is as read off the page; see resolve_partials.
    """
    flow, pages = _page_flow(segmented).alias("f"), segmented.alias("s")
    tops = flow.where("joins OR long").join(pages, _same_page("f", "s")).select(
        "f.volume", "f.page_no", "f.run", "f.joins", "f.leading_closes", "s.image", F.coalesce("s.leading", "s.short_leading").alias("top")
    )
    orphans = tops.where("NOT joins").select(
        "volume", "page_no", F.lit(0).cast("bigint").alias("seq"), _stem(F.col("image")).alias("stem"), F.col("top").alias("text"),
        F.array("image").alias("images"), F.col("page_no").alias("last_page"), (~F.col("leading_closes")).alias("partial"), F.lit(True).alias("orphan"),
    )
    more = tops.where("joins").groupBy("volume", "run").agg(
        F.array_sort(F.collect_list(F.struct("page_no", "top", "image"))).alias("tops"), F.bool_or("leading_closes").alias("ends"), F.max("page_no").alias("last")
    )
    heads = flow.where("has").select("volume", "page_no", (F.col("run") + 1).alias("run")).alias("h")
    own = segmented.select("volume", "page_no", "image", F.size("entries").alias("n"), F.posexplode("entries").alias("i", "e")).alias("o")
    own = own.join(heads, _same_page("o", "h")).select("o.*", F.when(F.col("o.i") + 1 == F.col("o.n"), F.col("h.run")).alias("run")).alias("o")
    own = own.join(more.alias("m"), F.col("o.volume").eqNullSafe(F.col("m.volume")) & (F.col("o.run") == F.col("m.run")), "left")
    runs_on = F.col("m.tops").isNotNull()
    records = own.select(
        "o.volume", "o.page_no", (F.col("o.i") + 1).cast("bigint").alias("seq"), _stem(F.col("o.image")).alias("stem"),
        F.when(runs_on, reflow(F.concat(F.array("o.e.text"), F.transform("m.tops", lambda t: t["top"])))).otherwise(F.col("o.e.text")).alias("text"),
        F.when(runs_on, F.concat(F.array("o.image"), F.transform("m.tops", lambda t: t["image"]))).otherwise(F.array("o.image")).alias("images"),
        F.coalesce("m.last", "o.page_no").alias("last_page"), F.when(runs_on, ~F.col("m.ends")).otherwise(F.col("o.e.partial")).alias("partial"), F.lit(False).alias("orphan"),
    )
    every = records.unionByName(orphans)
    named = F.when((F.col("stem") == "") & ~F.col("orphan"), "page").otherwise(F.col("stem"))
    return every.withColumn("id", _numbered(named, F.col("seq"))).drop("stem")


def page_confidence(segmented: DataFrame) -> DataFrame:
    """volume, page_no, page_type, records, confidence; a page without records whose text joined an open record is sound."""
    flow = _page_flow(segmented).select("volume", "page_no", "joins").alias("f")
    both = segmented.alias("s").join(flow, _same_page("s", "f"))
    bumped = F.when(F.col("joins") & (F.size("entries") == 0), F.greatest("confidence", F.lit(0.85))).otherwise(F.col("confidence"))
    return both.select("s.volume", "s.page_no", "s.image", "s.page_type", F.size("entries").cast("bigint").alias("records"), bumped.alias("confidence"))


def resolve_partials(records: DataFrame, segmented: DataFrame) -> DataFrame:
    """records with partial settled by position: an open record is complete if another starts on or before its last page,
    or if the next page can be read, has records and begins with one."""
    order = W.partitionBy("volume").orderBy("page_no", "seq")
    pages = W.partitionBy("volume").orderBy("page_no")
    clean = F.col("page_type").isNull() & F.col("leading").isNull() & (F.size("entries") > 0)
    after = segmented.select(F.col("volume").alias("_v"), F.col("page_no").alias("_p"), clean.alias("_clean")).withColumn("_next", F.lead("_clean").over(W.partitionBy("_v").orderBy("_p"))).drop("_clean")
    place = records.select("volume", "page_no", "seq", "last_page", "partial")
    place = place.withColumn("_starts", F.lead("page_no").over(order))
    settled = place.join(after, [F.col("volume").eqNullSafe(F.col("_v")), F.col("last_page") == F.col("_p")], "left").select(
        "volume", "page_no", "seq", (F.col("partial") & ~F.coalesce(F.col("_starts") <= F.col("last_page"), F.lit(False)) & ~F.coalesce("_next", F.lit(False))).alias("partial")
    )
    same = _same_page("r", "t") & (F.col("r.seq") == F.col("t.seq"))
    return records.drop("partial").alias("r").join(settled.alias("t"), same).select("r.*", "t.partial")


def canonical_records(records: DataFrame) -> DataFrame:
    """volume, id (stem of the first image and a running number), text, images, partial (null unless true)."""
    numbered = records.withColumn("_stem", _stem(F.get("images", F.lit(0))))
    numbered = numbered.withColumn("_n", F.row_number().over(W.partitionBy("volume", "_stem").orderBy("page_no", "seq")))
    return numbered.select("volume", "page_no", "seq", _numbered(F.col("_stem"), F.col("_n")).alias("id"), "text", "images", F.when(F.col("partial"), True).alias("partial"))


def volume_statistics(segmented: DataFrame, records: DataFrame) -> DataFrame:
    """pages, entries, cross_page, still_partial, low_confidence_pages and error_pages of each volume."""
    pages = page_confidence(segmented)
    error = F.coalesce(F.col("page_type") == "error", F.lit(False))
    by_page = pages.groupBy("volume").agg(F.count(F.lit(1)).alias("pages"), F.count_if((F.col("confidence") < TRUSTED) & ~error).alias("low_confidence_pages"), F.count_if(error).alias("error_pages"))
    by_record = records.groupBy(F.col("volume").alias("_v")).agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.size("images") > 1).alias("cross_page"), F.count_if("partial").alias("still_partial"))
    joined = by_page.join(by_record, F.col("volume").eqNullSafe(F.col("_v")), "left")
    return joined.select("volume", "pages", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("entries", "cross_page", "still_partial")], "low_confidence_pages", "error_pages")
