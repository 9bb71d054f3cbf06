"""Queries on pages: segmentation of register.py's pages, routing and dossiers, re-flow of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.lines import reflow
from ..operators import evaluation as E
from ..operators import routing as R
from ..operators import segmentation as S
from ..operators import staging
from ..session import staged, table
from .catalogue import _TYPED, plain, query
from .register import pages as register_pages


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(S.segment_pages(register_pages(spark, sf_dir)))


@plain
def segment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.segment_pages(register_pages(spark, sf_dir))
    return rows.select("volume", "page_no", F.to_json("entries").alias("entries"), "leading", "short_leading", F.array_join("dropped", "|").alias("dropped"), "page_type", "confidence")


@plain
def page_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.page_confidence(_segmented(spark, sf_dir))


@plain
def stitched_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stitch(_segmented(spark, sf_dir)).withColumn("images", F.array_join("images", ";"))


@plain
def partial_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _segmented(spark, sf_dir)
    return S.resolve_partials(S.stitch(pages), pages).select("volume", "page_no", "seq", "partial", "orphan", "last_page")


@plain
def canonical_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _segmented(spark, sf_dir)
    return S.canonical_records(S.resolve_partials(S.stitch(pages), pages)).withColumn("images", F.array_join("images", ";"))


@plain
def segmentation_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _segmented(spark, sf_dir)
    return S.volume_statistics(pages, S.resolve_partials(S.stitch(pages), pages))


@plain
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.page_routes(S.page_confidence(_segmented(spark, sf_dir)))


@plain
def record_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _segmented(spark, sf_dir)
    routes = R.page_routes(S.page_confidence(pages))
    records = S.canonical_records(S.resolve_partials(S.stitch(pages), pages))
    return R.record_dispositions(records, routes)


@plain
def disposition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.disposition_totals(record_dispositions(spark, sf_dir))


@plain
def segmentation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as reference, the same passages as predicted, every seventh cut short."""
    k = F.col("item_id")
    rows = table(spark, sf_dir, "benchmark").withColumn("volume", k % 16)
    refs = rows.select("volume", F.lpad((k % 4).cast("string"), 4, "0").alias("page"), "text")
    preds = rows.select("volume", F.array(F.lpad((k % 4).cast("string"), 4, "0")).alias("pages"), F.when(k % 7 == 0, F.expr("left(text, cast(length(text) / 2 as int))")).otherwise(F.col("text")).alias("text"), (k % 14 == 0).alias("partial"))
    return E.score_segmentation(refs, preds)


@plain
def review_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twelve pages with records of each volume: a report."""
    return E.review_slice(_segmented(spark, sf_dir))


_CUES = "len(regexp_extract_all({0}, '{1}'))"
_WORDS = lambda p: p.replace("(?iu)", "(?i)").replace("'", "''")


@query(f"""WITH e AS (SELECT source AS volume, count(*) AS pages, sum({_CUES.format("coalesce(text, '')", _WORDS(R.ADMINISTRATIVE))})::BIGINT AS administrative_cues, sum({_CUES.format("coalesce(text, '')", _WORDS(R.SACRAMENTAL))})::BIGINT AS sacramental_cues,
  count(*) FILTER (page_type = 'register') AS registers, count(*) FILTER (page_type = 'index') AS indexes FROM {_TYPED % 'documents'} WHERE source IS NOT NULL GROUP BY source),
t AS (SELECT *, CASE WHEN length(volume) % 2 = 0 THEN 1 ELSE 0 END AS register_title_cues FROM e)
SELECT *, CASE kind WHEN 'sacramental' THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM (SELECT *, CASE WHEN (register_title_cues >= 1 AND registers::DOUBLE / pages >= 0.7) OR (registers::DOUBLE / pages >= 0.2 AND sacramental_cues >= greatest(15, pages * 0.05)) THEN 'sacramental' ELSE 'unknown' END AS kind FROM t)""")
def cue_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for volumes; a source whose name has an even length has a register's title."""
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("volume"), "text")
    titles = F.when(F.length("volume") % 2 == 0, "Livro 1").otherwise("papers")
    items = docs.select("volume").distinct().select("volume", titles.alias("title"), F.lit(1).alias("images"))
    return R.source_kind(R.source_evidence(docs, items)).drop("multi_image_items")


@plain
def volume_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _segmented(spark, sf_dir)
    found = register_pages(spark, sf_dir)
    items = found.select("volume").distinct().select("volume", F.lit("Livro de baptismos, parish register").alias("title"), F.lit(1).alias("images"))
    return R.volume_routes(R.source_kind(R.source_evidence(found, items)), R.page_routes(S.page_confidence(pages)))


@query("""SELECT volume, item, id, title, pages, source_images, md5(faithful_text) AS faithful_md5 FROM (SELECT conv_id AS volume, 1 AS item, 'doc-001' AS id, 'Untitled archival item' AS title, count(*) AS pages, string_agg('t' || turn || '.jpg', ';' ORDER BY turn, role, text) AS source_images,
string_agg(regexp_replace('[source image: t' || turn || '.jpg]' || chr(10) || coalesce(text, ''), '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) ORDER BY turn, role, text) AS faithful_text, max(upper(trim(coalesce(text, '')))) AS sole FROM conversations GROUP BY conv_id) WHERE NOT (pages = 1 AND sole IN ('START', 'END'))""")
def administrative_dossiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations stand for items, turns for images."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    images = F.transform(turns, lambda x: F.struct(F.concat(F.lit("t"), x["turn"].cast("string"), F.lit(".jpg")).alias("file"), x["text"].alias("transcription")))
    items = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("volume")).agg(images.alias("images")).select("volume", F.lit(1).alias("item"), F.lit("").alias("title"), "images")
    return R.dossiers(items).select("volume", "item", "id", "title", "pages", "source_images", F.md5("faithful_text").alias("faithful_md5"))


_GLUE = r"CASE WHEN b = '' THEN a WHEN a = '' THEN b WHEN left(b, 1) IN ('-', '=') THEN CASE WHEN right(a, 1) IN ('-', '=') THEN left(a, length(a) - 1) ELSE a END || ltrim(substr(b, 2)) WHEN right(a, 1) = '-' THEN left(a, length(a) - 1) || b WHEN right(a, 1) = '=' AND (regexp_matches(b, '^\p{Ll}') OR regexp_matches(a, '(^|[^\p{L}\p{N}_])[\p{L}\p{N}_]{1,2}=$')) THEN left(a, length(a) - 1) || b ELSE a || ' ' || b END"


@query(rf"""SELECT doc_id, md5(trim(regexp_replace(list_reduce(list_prepend('', list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda a, b: {_GLUE}), '\s+', ' ', 'g'))) AS flowed_md5 FROM documents""")
def reflow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(reflow(F.split(F.coalesce("text", F.lit("")), "\n"))).alias("flowed_md5"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(list_reduce(list_prepend('', list_filter(list_transform(string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')),
lambda a, x: CASE WHEN a = '' THEN x WHEN right(a, 1) = '-' THEN left(a, length(a) - 1) || x ELSE a || ' ' || x END), '\s+', ' ', 'g'))) AS clean_md5 FROM documents""")
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(V.cleaned_lines(F.col("text"))).alias("clean_md5"))


@query(r"""SELECT doc_id, count(*) FILTER (n BETWEEN 1 AND 300) AS expected, n_chars % 3 AS records, count(*) FILTER (n BETWEEN 1 AND 300) = n_chars % 3 AS ok FROM (SELECT doc_id, n_chars, coalesce(try_cast(regexp_extract(x, '^\s*([0-9]{1,3})\.{0,2}\s*$', 1) AS INT), try_cast(regexp_extract(x, '^\s*([0-9]{1,3})\.{1,2}\s+\S', 1) AS INT)) AS n FROM (SELECT doc_id, n_chars, unnest(string_split(coalesce(text, ''), chr(10))) AS x FROM documents)) GROUP BY doc_id, n_chars""")
def margin_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand for pages; the number of records is made up from their length."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("volume"), F.lit(1).alias("page_no"), "text", (F.col("n_chars") % 3).alias("records"))
    return E.margin_check(docs, docs.select("volume", "page_no", "records")).select(F.col("volume").alias("doc_id"), "expected", "records", "ok")


@query("""SELECT volume, count(*) AS predicted_entries, count(v) AS judged, count(*) FILTER (v = 'correct') AS exact_correct, count(*) FILTER (v = 'merge') AS over_splits_merge, count(*) FILTER (v = 'split') AS under_splits, count(*) FILTER (v = 'bad') AS wrong,
any_value(m) AS pages_with_missing_starts, count(*) FILTER (v IN ('merge', 'bad')) AS false_positive_boundaries, round(count(*) FILTER (v = 'correct')::DOUBLE / nullif(count(v), 0), 3) AS precision,
round(count(*) FILTER (v IN ('correct', 'split'))::DOUBLE / nullif(count(*) FILTER (v IN ('correct', 'split')) + count(*) FILTER (v = 'split') + any_value(m), 0), 3) AS recall_approx
FROM (SELECT o_custkey % 50 AS volume, CASE o_orderkey % 9 WHEN 0 THEN 'merge' WHEN 1 THEN 'split' WHEN 2 THEN 'bad' WHEN 3 THEN NULL ELSE 'correct' END AS v FROM orders) JOIN (SELECT o_custkey % 50 AS volume, count(*) FILTER (o_orderkey % 40 = 0) AS m FROM orders GROUP BY 1) USING (volume) GROUP BY volume""")
def correction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for judged records."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("volume"), k.alias("entry"))
    verdict = F.when(k % 9 == 0, "merge").when(k % 9 == 1, "split").when(k % 9 == 2, "bad").when(k % 9 == 3, None).otherwise("correct")
    judged = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("volume"), k.alias("entry"), verdict.alias("verdict"))
    return E.correction_score(judged, rows.where("entry % 40 = 0").select("volume", F.col("entry").alias("page")))


_KEY = r"lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')))"


@query(f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source, {_KEY} ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def deduplicated_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.deduplicated(table(spark, sf_dir, "documents"), "source", "text", F.col("doc_id")).select("source", "doc_id")


@query("SELECT source, doc_id, lang || '-' || CASE WHEN n < 10 THEN '0' ELSE '' END || n AS id FROM (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents)")
def renumbered_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages stand for first pages."""
    return staging.renumbered(table(spark, sf_dir, "documents").select("source", "lang", "doc_id"), "source", "lang", F.col("doc_id")).select("source", "doc_id", "id")
