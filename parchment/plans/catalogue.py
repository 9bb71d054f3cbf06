"""Registered queries of the library, bound to the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as T
from ..operators import relations as R
from ..operators import routing as G
from ..operators.ratios import near_copies_by_ratio
from ..session import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_PLAIN: dict[str, Query] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        _ORACLES[f.__name__] = oracle
        return f

    return add


def plain(f: Query) -> Query:
    """A query without SQL; the tests hold it against brute force."""
    _PLAIN[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain_queries() -> dict[str, Query]:
    """Queries that have no SQL; the tests hold them against brute force."""
    return dict(_PLAIN)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_TYPED = r"""(SELECT *, CASE WHEN regexp_matches(t, '(?i)\[transcription failed|max retries reached|finish\s?reason[:.]') THEN 'error'
  WHEN len(ls) = 0 OR length(trim(t, ' ')) < 120 THEN 'blank'
  WHEN len(ls) >= 5 AND len(list_filter(ls, lambda x: starts_with(ltrim(x, ' '), '|') OR regexp_matches(x, '(?i)\bf(ol)?\.?\s*[0-9]{1,4}\s*\|?\s*$'))) >= 0.4 * len(ls) THEN 'index'
  ELSE 'register' END AS page_type
  FROM (SELECT *, coalesce(text, '') AS t, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') <> '') AS ls FROM %s))"""
#: Of pages on which no record opens, as in these tables: they have a confidence of 0.9 if nearly blank, else of 0.45.
_ROUTE = f"CASE page_type WHEN 'error' THEN '{G.RETRANSCRIBE}' WHEN 'index' THEN '{G.SKIP}' ELSE CASE WHEN length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) < 120 THEN '{G.DETERMINISTIC}' ELSE '{G.FALLBACK}' END END"


@query(f"SELECT source, page_type, count(*) AS pages FROM {_TYPED % 'documents'} GROUP BY source, page_type")
def page_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source", T.page_type(F.col("text")).alias("page_type")).agg(F.count(F.lit(1)).alias("pages"))


@query(f"SELECT source, {_ROUTE} AS route, count(*) AS pages, sum(n_chars)::BIGINT AS chars FROM {_TYPED % 'documents'} GROUP BY source, route")
def route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = G.routed(table(spark, sf_dir, "documents").select("source", "text", "n_chars"), "text")
    return routed.groupBy("source", "route").agg(F.count(F.lit(1)).alias("pages"), F.sum("n_chars").alias("chars"))


flagship = route_summary


@query(f"""WITH r AS (SELECT conv_id, {_ROUTE} AS route FROM {_TYPED % 'conversations'})
SELECT conv_id, CASE WHEN bool_and(route = 'deterministic-sacramental') THEN 'production' WHEN bool_or(route = 'retranscribe') THEN 'blocked-retranscribe' WHEN bool_or(route = 'luna-sacramental-fallback') THEN 'needs-fallback' WHEN bool_or(route = 'skip-index') THEN 'index-context' ELSE 'review' END AS disposition FROM r GROUP BY conv_id""")
def worst_disposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.worst_disposition(G.routed(table(spark, sf_dir, "conversations"), "text"), "conv_id", "route")


@query("""SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'qa-empty-page' WHEN length(text) > 1600 OR d > 14 THEN 'qa-admin-dense' ELSE 'qa-admin-compact-pilot' END AS route, d AS candidates
FROM (SELECT doc_id, text, len(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+ [A-Z][a-z]+')) + len(regexp_extract_all(coalesce(text, ''), '[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}')) AS d FROM documents)""")
def admin_density_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lambda p: F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(p), F.lit(0)))
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", (found("[A-Z][a-z]+ [A-Z][a-z]+") + found("[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}")).cast("bigint").alias("candidates"))
    route = F.when(F.coalesce("text", F.lit("")) == "", "qa-empty-page").when((F.length("text") > 1600) | (F.col("candidates") > 14), "qa-admin-dense").otherwise("qa-admin-compact-pilot")
    return rows.select("doc_id", route.alias("route"), "candidates")


_NAME = "array_to_string(list_filter(regexp_split_to_array(regexp_replace(translate(lower({0}), '" + T.ACCENTED + "', '" + T.PLAIN + "'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+'), lambda t: t <> '' AND t NOT IN (" + ", ".join(f"'{t}'" for t in T.TITLES) + ")), ' ')"


@query(f"SELECT p_partkey, {_NAME.format('p_name')} AS name FROM part")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_name(F.col("p_name")).alias("name"))


def _sql_fold(token: str) -> str:
    """The phonetic steps without lookahead; doubles go by comparing neighbours."""
    steps = (("ch", "C"), ("ll", "L"), ("qu?", "k"), ("c([ei])", "s\\1"), ("c$", "s"), ("g([ei])", "X\\1"), ("g$", "X"), ("c", "k"), ("[zx]", "s"), ("[vw]", "b"), ("j", "X"), ("y", "i"), ("h", ""), ("C", "c"), ("L", "i"), ("X", "x"))
    for a, b in steps:
        token = f"regexp_replace({token}, '{a}', '{b}', 'g')"
    return token


@query(f"""WITH k AS (SELECT p_partkey, {_sql_fold(f"coalesce(string_split({_NAME.format('p_name')}, ' ')[1], '')")} AS f FROM part)
SELECT block, count(*) AS mentions, (count(*) * (count(*) - 1) // 2)::BIGINT AS pairs FROM
(SELECT coalesce((SELECT string_agg(c, '' ORDER BY i) FROM (SELECT i, substr(f, i, 1) AS c, CASE WHEN i > 1 THEN substr(f, i - 1, 1) ELSE '' END AS b FROM (SELECT unnest(generate_series(1, length(f))) AS i)) WHERE c <> b), '') AS block FROM k) GROUP BY block""")
def block_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.block_candidates(table(spark, sf_dir, "part"), "p_name")


@query("""SELECT o_orderkey, d AS partial, CASE len(string_split(d, '-')) WHEN 1 THEN d || '-01-01' WHEN 2 THEN d || '-01' ELSE d END AS first_day,
CASE len(string_split(d, '-')) WHEN 1 THEN d || '-12-31' WHEN 2 THEN d || '-' || [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][string_split(d, '-')[2]::INT]::VARCHAR ELSE d END AS last_day
FROM (SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, [4, 7, 10][(o_orderkey % 3 + 1)::INT]) AS d FROM orders)""")
def partial_date_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    d = F.when(F.col("o_orderkey") % 3 == 0, F.substring(day, 1, 4)).when(F.col("o_orderkey") % 3 == 1, F.substring(day, 1, 7)).otherwise(day)
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("partial")).select("o_orderkey", "partial", dates.completed(F.col("partial"), False).alias("first_day"), dates.completed(F.col("partial"), True).alias("last_day"))


@query(r"SELECT doc_id, list_sum(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+|[^A-Za-z0-9_\s]'), lambda u: CASE WHEN regexp_full_match(u, '[A-Za-z0-9]+') THEN greatest(1, round_even(length(u) / 4.2::DOUBLE, 0)::BIGINT) ELSE 1 END))::BIGINT AS tokens FROM documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT doc_id, source || '-' || lpad(row_number() OVER (PARTITION BY source ORDER BY doc_id)::VARCHAR, 6, '0') AS record_id FROM documents")
def canonical_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.numbered(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id")
    return rows.select("doc_id", F.concat_ws("-", "source", F.lpad(F.col("n").cast("string"), 6, "0")).alias("record_id"))


@query("SELECT source, batch, count(*) AS requests, min(doc_id) AS first_doc FROM (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS batch FROM documents) GROUP BY source, batch")
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.batches(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 10).groupBy("source", "batch").agg(F.count(F.lit(1)).alias("requests"), F.min("doc_id").alias("first_doc"))


@query("SELECT conv_id, turn, n AS next_turn FROM (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n IS NOT NULL")
def page_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lead("turn").over(W.partitionBy("conv_id").orderBy("turn")).alias("next_turn"))
    return rows.where("next_turn IS NOT NULL")


@query(r"""WITH d AS (SELECT source, doc_id, substr(lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), ' ')), 1, 800) AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents)
SELECT a.source, a.doc_id, b.doc_id AS other FROM d a JOIN d b ON a.source = b.source AND b.n BETWEEN a.n + 1 AND a.n + 4 AND a.t = b.t WHERE a.t <> ''""")
def near_dup_next4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.near_copies(table(spark, sf_dir, "documents"), "source", "doc_id", "text")


@plain
def near_dup_next4_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL has no SequenceMatcher. Documents have no principal."""
    return near_copies_by_ratio(table(spark, sf_dir, "documents"), "source", "doc_id", "text")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
p AS (SELECT *, substr(day, 1, 4)::INT * 372 + substr(day, 6, 2)::INT * 31 + substr(day, 9, 2)::INT AS v FROM o),
q AS (SELECT *, lag(v) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM p) SELECT o_custkey, o_orderkey, day FROM q WHERE v < b - 30""")
def chronology_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.chronology_breaks(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "o_custkey", "o_orderkey", "day")


@query("""WITH o AS (SELECT o_orderkey, (1480 + o_orderkey % 440)::VARCHAR || '-' || (o_orderkey % 14)::VARCHAR || '-' || (o_orderkey % 33)::VARCHAR AS day, 1480 + o_orderkey % 440 AS y, o_orderkey % 14 AS m, o_orderkey % 33 AS d FROM orders)
SELECT o_orderkey, day FROM o WHERE NOT (y BETWEEN 1500 AND 1900 AND m BETWEEN 1 AND 12 AND d >= 1 AND d <= coalesce([31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m::INT], 0))""")
def impossible_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    day = F.concat_ws("-", (1480 + k % 440).cast("string"), (k % 14).cast("string"), (k % 33).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day")).where(dates.impossible(F.col("day")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(known, "l_orderkey", "left_anti")


@query("SELECT field, value, count(*) AS n FROM (SELECT 'p_type' AS field, lower(trim(p_type)) AS value FROM part UNION ALL SELECT 'p_brand', lower(trim(p_brand)) FROM part) GROUP BY field, value")
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.lower(F.trim(c)).alias("value")) for c in ("p_type", "p_brand")]))
    return table(spark, sf_dir, "part").select(pairs.alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT d.doc_id, source, quality, quality IS NOT NULL AS parsed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def faithful_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").withColumn("parsed", F.col("quality").isNotNull())


@query("SELECT source, count(*) AS missing FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("missing"))


_LINKS = "SELECT 'c' || o_custkey::VARCHAR AS s, l_returnflag AS k, 's' || l_suppkey::VARCHAR AS t, l_orderkey AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("e"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("s"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("e"), F.col("l_returnflag").alias("k"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("t"))
    return R.typed_edges(lines.join(orders, "e"), "s", "k", "t", "e")


@query(f"SELECT s AS source, k AS type, t AS target, count(*) AS weight, count(DISTINCT e) AS entries FROM ({_LINKS}) GROUP BY s, k, t")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


_DEGREES = f"SELECT node, count(*) AS degree FROM (SELECT unnest([s, t]) AS node FROM (SELECT DISTINCT s, k, t FROM ({_LINKS}))) GROUP BY node"


@query(_DEGREES)
def graph_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.degrees(_edges(spark, sf_dir))


@query(f"{_DEGREES} ORDER BY degree DESC, node LIMIT 10")
def graph_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top ten report."""
    return R.degrees(_edges(spark, sf_dir)).orderBy(F.col("degree").desc(), "node").limit(10)


_SCORE = """SELECT lang, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1, tp, fp, fn FROM
(SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) WHEN fn = 0 THEN 1 ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 1 END AS r FROM
(SELECT lang, count(*) FILTER (g AND h) AS tp, count(*) FILTER (NOT g AND h) AS fp, count(*) FILTER (g AND NOT h) AS fn FROM (SELECT lang, quality = 1 AS g, n_chars >= 600 AS h FROM documents JOIN labels USING (doc_id)) GROUP BY lang))"""


@query(_SCORE)
def prf_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("n_chars") >= 600).alias("h")).join(table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("g")), "doc_id")
    counts = rows.groupBy("lang").agg(F.count_if(F.col("g") & F.col("h")).alias("tp"), F.count_if(~F.col("g") & F.col("h")).alias("fp"), F.count_if(F.col("g") & ~F.col("h")).alias("fn"))
    return counts.select("lang", *R.prf(F.col("tp"), F.col("fp"), F.col("fn")), "tp", "fp", "fn")


@query("SELECT user_id, event_id, round(s::DOUBLE, 2) AS spent, round(s::DOUBLE, 2) <= 500 AS within FROM (SELECT user_id, event_id, sum(value::DECIMAL(18,2)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS s FROM events)")
def spend_running_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.running_within(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", 500.0).select("user_id", "event_id", "spent", "within")


@query("SELECT event_type, CASE WHEN k IS NULL THEN 'malformed' WHEN k > 50 THEN 'rejected' ELSE 'accepted' END AS status, count(*) AS n FROM (SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type, status")
def response_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    rows = table(spark, sf_dir, "events").select("event_type", F.when(k.isNull(), "malformed").when(k > 50, "rejected").otherwise("accepted").alias("status"))
    return rows.groupBy("event_type", "status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = o.o_orderkey) ORDER BY o_orderkey LIMIT 100")
def unsent_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next hundred requests that were not sent."""
    sent = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(sent, "o_orderkey", "left_anti").orderBy("o_orderkey").limit(100)


_COLLAPSED = "coalesce((SELECT string_agg(c, '' ORDER BY i) FROM (SELECT i, substr(f, i, 1) AS c, CASE WHEN i > 1 THEN substr(f, i - 1, 1) ELSE '' END AS b FROM (SELECT unnest(generate_series(1, length(f))) AS i)) WHERE c <> b), '')"


@query(f"SELECT token, {_COLLAPSED} AS phonetic FROM (SELECT token, {_sql_fold('token')} AS f FROM (SELECT DISTINCT unnest(string_split({_NAME.format('p_name')}, ' ')) AS token FROM part) WHERE token <> '')")
def phonetic_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "part").select(F.explode(T.name_tokens(F.col("p_name"))).alias("token")).distinct()
    return tokens.select("token", T.phonetic_fold(F.col("token")).alias("phonetic"))


@query("SELECT term, n, samples FROM (SELECT p_name AS term, count(*) AS n, array_to_string(list_slice(list(p_partkey ORDER BY p_partkey), 1, 3), ',') AS samples FROM part GROUP BY p_name)")
def term_audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.term_samples(table(spark, sf_dir, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")


@query("SELECT c_nationkey, seen, in_vocab, round(in_vocab::DOUBLE / seen, 4) AS rate FROM (SELECT c_nationkey, count(*) AS seen, count(*) FILTER (lower(trim(c_mktsegment)) IN ('building', 'furniture', 'machinery')) AS in_vocab FROM customer WHERE trim(c_mktsegment) <> '' GROUP BY c_nationkey)")
def vocab_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.conformance(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", ("building", "furniture", "machinery"))


@query("SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS principals FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE coalesce(n, 0) <> CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE coalesce(n, 0) END")
def event_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for events: one principal for status F, two for O."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    found = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    n = F.coalesce("n", F.lit(0))
    wrong = n != F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(n)
    return found.where(wrong).select("o_orderkey", "o_orderstatus", n.alias("principals"))


@query("WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_partkey <> l_suppkey) SELECT a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM e r WHERE r.a = e.b AND r.b = e.a)")
def nonreciprocal(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return R.nonreciprocal(links, "a", "b")


@query("SELECT DISTINCT doc_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)")
def extra_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "documents").select("doc_id")
    return table(spark, sf_dir, "labels").select("doc_id").join(known, "doc_id", "left_anti").distinct()


@query(f"SELECT k AS type, count(*) AS edges, sum(w)::BIGINT AS links, count(*) FILTER (n > 1) AS cross_entry FROM (SELECT s, k, t, count(*) AS w, count(DISTINCT e) AS n FROM ({_LINKS}) GROUP BY s, k, t) GROUP BY k")
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("edges"), F.sum("weight").alias("links"), F.count_if(F.col("entries") > 1).alias("cross_entry"))


@query("""SELECT doc_id, array_to_string(list_distinct(regexp_extract_all(coalesce(text, ''), '[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}')).list_sort(), ';') AS dates,
array_to_string(list_distinct(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+ [A-Z][a-z]+')).list_sort(), ';') AS names FROM documents""")
def page_index_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lambda p: F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(p), F.lit(0)))), ";")
    return table(spark, sf_dir, "documents").select("doc_id", found("[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}").alias("dates"), found("[A-Z][a-z]+ [A-Z][a-z]+").alias("names"))


@query("SELECT conv_id, printf('%d--p%02d-%02d', conv_id, min(n), max(n)) AS chunk_id, count(*) AS pages FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations) GROUP BY conv_id, (n - 1) // 2")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns stand for pages; chunks of two."""
    return R.page_chunks(table(spark, sf_dir, "conversations"), "conv_id", ("turn", "role", "text"), 2)


#: Rules of an id, their cases and their sequence; a rule applies where all its cases hold.
_RULES = (("r1", (), 30), ("r2", ("en",), 10), ("r3", ("en", "long"), 20), ("r4", ("labelled",), 5))


@query("""SELECT doc_id, array_to_string(list_filter(['r4', 'r2', 'r3', 'r1'], lambda r: r = 'r1' OR (r = 'r2' AND en) OR (r = 'r3' AND en AND big) OR (r = 'r4' AND lab)), ',') AS rules
FROM (SELECT d.doc_id, coalesce(lang = 'en', false) AS en, coalesce(n_chars >= 600, false) AS big, l.doc_id IS NOT NULL AS lab FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id)""")
def keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("_l", F.lit("labelled"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(labelled, "doc_id", "left")
    keywords = F.array_compact(F.array("lang", F.when(F.col("n_chars") >= 600, "long"), "_l"))
    return docs.select("doc_id", R.matching_rules(keywords, _RULES).alias("rules"))


from . import pages, records, requests  # noqa: E402, F401  they add their queries to the tables above
