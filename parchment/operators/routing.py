"""Where pages and volumes go: the kind of a source, routes of its pages, dossiers, dispositions, delivery.

Routing only chooses; what is unsure goes to review. Names of routes and kinds are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import page_type
from .segmentation import TRUSTED, confidence, page_records

# Words that tell administrative from sacramental sources and mark a register's title, as Java patterns.
ADMINISTRATIVE = r"(?iu)\b(?:cofrad[ií]a|hermandad|petici[oó]n|solicita|expediente|cabildo|mayordomo|constituci[oó]n|licencia|reglamento)\b"
SACRAMENTAL = r"(?iu)\b(?:bautiz\w*|baptis\w*|matrim[oô]ni\w*|casament\w*|obit\w*|[oó]bitos?\w*|sepult\w*|enterr\w*|fallec\w*|defunt\w*|burial\w*)\b"
TITLE = r"(?iu)\b(?:parish|baptism\w*|bautism\w*|marriage|matrim[oô]ni\w*|burial|obit\w*|[oó]bitos?\w*|difuntos?|registros?\s+parroquiales|livro)\b"
# Routes and dispositions.
RETRANSCRIBE, SKIP, FALLBACK, DETERMINISTIC = "retranscribe", "skip-index", "luna-sacramental-fallback", "deterministic-sacramental"
MARKERS = ("START", "END")


def cues(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


def source_evidence(pages: DataFrame, items: DataFrame) -> DataFrame:
    """For each volume: cue counts, title cues, items of several images, and pages of each type.

    pages: volume, text; items: volume, title, images (their number).
    """
    kinds = page_type(F.col("text"))
    of_pages = pages.withColumn("_k", kinds).groupBy("volume").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(cues(F.col("text"), ADMINISTRATIVE)).alias("administrative_cues"), F.sum(cues(F.col("text"), SACRAMENTAL)).alias("sacramental_cues"),
        F.count_if(F.expr("_k = 'register'")).alias("registers"), F.count_if(F.expr("_k = 'index'")).alias("indexes"),
    )
    of_items = items.groupBy("volume").agg(F.sum(cues(F.col("title"), TITLE)).alias("register_title_cues"), F.count_if(F.expr("images > 1")).alias("multi_image_items"))
    return of_pages.join(of_items, "volume", "left").fillna(0, ["register_title_cues", "multi_image_items"])


def source_kind(evidence: DataFrame) -> DataFrame:
    """evidence with kind (administrative, sacramental or unknown) and confidence."""
    admin, sacral, title = F.col("administrative_cues"), F.col("sacramental_cues"), F.col("register_title_cues")
    share = lambda c: c / F.nullif(F.col("pages"), F.lit(0))
    dossier = (admin >= F.greatest(F.lit(5), sacral * 3)) & (title == 0) & (F.col("multi_image_items") > 0)
    shaped = ((title >= 2) & (share(F.col("registers") + F.col("indexes")) >= 0.6)) | ((title >= 1) & (share(F.col("registers")) >= 0.7))
    strong = (share(F.col("registers")) >= 0.2) & (sacral >= F.greatest(F.lit(15.0), F.col("pages") * 0.05))
    kind = F.when(dossier, "administrative").when(shaped | strong, "sacramental").otherwise("unknown")
    return evidence.withColumn("kind", kind).withColumn("confidence", F.when(kind == "administrative", 0.95).when(kind == "sacramental", 0.9).otherwise(0.0))


def route_of(kind: Column, trust: Column) -> Column:
    return F.when(kind == "error", RETRANSCRIBE).when(kind == "index", SKIP).when(trust < TRUSTED, FALLBACK).otherwise(DETERMINISTIC)


def routed(pages: DataFrame, text: str) -> DataFrame:
    """pages with page_type, confidence and route, each page by itself: one that only goes on from the page before is not trusted."""
    found = pages.withColumn("_page", page_records(F.coalesce(F.col(text), F.lit(""))))
    kind = F.coalesce(F.col("_page.page_type"), page_type(F.col(text)))
    typed = found.withColumn("page_type", kind)
    trust = confidence(F.col("_page.entries"), F.col("_page.leading"), F.col(text), F.col("page_type"))
    typed = typed.withColumn("confidence", trust).drop("_page")
    return typed.withColumn("route", route_of(F.col("page_type"), F.col("confidence")))


def disposition(alone: Column, route: Column) -> Column:
    """An aggregate: the worst of a record's pages decides what becomes of it; ``alone`` marks the row of a record without pages."""
    has = lambda r: F.bool_or(F.coalesce(route == r, F.lit(False)))
    good = F.bool_and(alone | F.coalesce(route == DETERMINISTIC, F.lit(False)))
    return F.when(good, "production").when(has(RETRANSCRIBE), "blocked-retranscribe").when(has(FALLBACK), "needs-fallback").when(has(SKIP), "index-context").otherwise("review")


def worst_disposition(pages: DataFrame, record: str, route: str) -> DataFrame:
    return pages.groupBy(record).agg(disposition(F.lit(False), F.col(route)).alias("disposition"))


def page_routes(confidences: DataFrame) -> DataFrame:
    """page_confidence of segmentation with route and reason: failures first, then indexes, then what is below the trusted confidence."""
    kind, low = F.coalesce("page_type", F.lit("")), F.col("confidence") < TRUSTED
    route = route_of(kind, F.col("confidence"))
    reason = F.when(kind == "error", "source transcription error").when(kind == "index", "not a record page").when(low, "low deterministic confidence").otherwise("confidence at or above 0.70")
    return confidences.withColumns({"route": route, "reason": reason})


def volume_routes(kinds: DataFrame, routes: DataFrame, override: str | None = None) -> DataFrame:
    """volume, kind, confidence, requires_review, route and pages: the routes of sacramental volumes; others go to review of their kind as a whole.

    ``override`` names the kind of all volumes, with confidence 1.
    """
    told = kinds.select("volume", *((F.lit(override).alias("kind"), F.lit(1.0).alias("confidence")) if override else ("kind", "confidence")))
    counts = routes.groupBy("volume", "route").agg(F.count(F.lit(1)).alias("pages"))
    sacral = told.where("kind = 'sacramental'").join(counts, "volume", "left").withColumn("requires_review", F.lit(False))
    rest = told.where("kind <> 'sacramental'").select("*", F.when(F.col("kind") == "unknown", "qa-source-kind").otherwise("qa-administrative").alias("route"), F.lit(1).cast("bigint").alias("pages"), F.lit(True).alias("requires_review"))
    return sacral.unionByName(rest)


def record_dispositions(records: DataFrame, routes: DataFrame) -> DataFrame:
    """volume, id and disposition of canonical records by the worst of their pages' routes (volume, image, route).

    A record without images is production, as nothing speaks against it; a page without a route sends it to review.
    """
    pages = records.select("volume", "id", F.explode_outer("images").alias("image"))
    here = pages.join(routes.select("volume", "image", "route").distinct(), ["volume", "image"], "left")
    return here.groupBy("volume", "id").agg(disposition(F.col("image").isNull(), F.col("route")).alias("disposition"))


def disposition_totals(dispositions: DataFrame) -> DataFrame:
    """Records of each disposition, by volume and in all (null volume)."""
    return dispositions.rollup("disposition", "volume").agg(F.count(F.lit(1)).alias("records")).where("disposition IS NOT NULL")


def dossiers(items: DataFrame) -> DataFrame:
    """Documents of an administrative export: volume, id by the item's place, title, pages, source_images, faithful_text.

    items: volume, item (from 1), title, images (array of file and transcription). Items of one image that only says START or END
    are markers; they leave a gap in the numbers.
    """
    only = F.upper(F.trim(F.coalesce(F.get("images", F.lit(0))["transcription"], F.lit(""))))
    marker = (F.size("images") == 1) & only.isin(*MARKERS)
    number = F.col("item").cast("string")
    text = lambda i: F.regexp_replace(F.concat(F.lit("[source image: "), F.coalesce(i["file"], F.lit("")), F.lit("]\n"), F.coalesce(i["transcription"], F.lit(""))), r"^\s+|\s+$", "")
    return items.where(~F.coalesce(marker, F.lit(False))).select(
        "volume", "item", F.concat(F.lit("doc-"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0"))).alias("id"),
        F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled archival item")).alias("title"), F.size("images").cast("bigint").alias("pages"),
        F.array_join(F.transform("images", lambda i: F.coalesce(i["file"], F.lit(""))), ";").alias("source_images"), F.array_join(F.transform("images", text), "\n\n").alias("faithful_text"),
    )


def delivered(records: DataFrame, keep_partials: bool = False) -> DataFrame:
    """Records as they are delivered: those cut off at a page's end go, unless they are kept."""
    return records if keep_partials else records.where(~F.coalesce("partial", F.lit(False)))


def volume_of(custom_id: Column, volumes: tuple[str, ...], experiment: str = "vocabtest") -> Column:
    """The volume that a request's id names; null for experiments and others."""
    found = F.regexp_extract(custom_id, "(" + "|".join(volumes) + ")", 1)
    return F.when(~F.coalesce(custom_id.contains(experiment), F.lit(True)), F.nullif(found, F.lit("")))


def matching_examples(rows: DataFrame, keywords: dict[str, str], every: bool, most: int, key: str, seed: int = 7) -> DataFrame:
    """Rows that have all, or any, of the keywords' values; at most ``most`` of them, chosen by a seeded hash of the key."""
    from functools import reduce

    tests = [F.coalesce(F.col(k) == v, F.lit(False)) for k, v in keywords.items()]
    test = reduce((lambda a, b: a & b) if every else (lambda a, b: a | b), tests) if tests else F.lit(True)
    return rows.where(test).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)
