"""Queries on requests and answers, the ledger, coverage and the cost model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cost as K
from ..operators import routing
from ..operators import staging as S
from ..session import table
from .catalogue import plain, query

# A request of two entries for each customer and one answer, some of them spoiled by arithmetic on the key; both engines run this.
_CONTENT = """CASE WHEN k % 11 = 0 THEN 'sorry, no' ELSE concat(CASE WHEN k % 3 = 0 THEN '```json ' ELSE '' END, '{{"results":[{{"entry":"', CAST(2 * k AS STRING), '","normalized":"x"}},{{"entry":"',
CAST(CASE WHEN k % 7 = 0 THEN 2 * k + 9 WHEN k % 19 = 0 THEN 2 * k ELSE 2 * k + 1 END AS STRING), '"}}]}}', CASE WHEN k % 3 = 0 THEN '```' ELSE '' END) END"""
_ANSWERS = f"""SELECT concat('r', CAST(CASE WHEN k % 43 = 0 THEN -k ELSE k END AS STRING)) AS custom_id, 1 AS pos, CASE WHEN k % 17 = 0 THEN 500 ELSE 200 END AS status_code, 1 AS choices, CASE WHEN k % 13 = 0 THEN 'length' ELSE 'stop' END AS finish_reason,
{_CONTENT} AS content, CASE WHEN k % 23 = 0 THEN NULL ELSE 100 + k % 50 END AS prompt_tokens, 40 + k % 30 AS completion_tokens FROM (SELECT c_custkey AS k FROM {{customer}}) AS c WHERE k % 29 <> 0
UNION ALL SELECT concat('r', CAST(k AS STRING)) AS custom_id, 2 AS pos, 200 AS status_code, 1 AS choices, 'stop' AS finish_reason, 'late' AS content, 1 AS prompt_tokens, 1 AS completion_tokens FROM (SELECT c_custkey AS k FROM {{customer}}) AS c WHERE k % 31 = 0"""


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("r"), k.cast("string")).alias("custom_id"), F.array((2 * k).cast("string"), (2 * k + 1).cast("string")).alias("entries"))


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ANSWERS, customer=table(spark, sf_dir, "customer"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.validated(_requests(spark, sf_dir), _answers(spark, sf_dir))


_SQL_JUDGED = f"""WITH requests AS (SELECT 'r' || c_custkey AS custom_id, [CAST(2 * c_custkey AS VARCHAR), CAST(2 * c_custkey + 1 AS VARCHAR)] AS entries FROM customer), answers AS ({_ANSWERS.format(customer='customer')}),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custom_id ORDER BY pos) AS n FROM answers) WHERE n = 1),
got AS (SELECT r.custom_id, r.entries, a.* EXCLUDE (custom_id), trim(regexp_replace(regexp_replace(trim(content), '(?i)^```(json)?', ''), '```$', '')) AS bare FROM requests r LEFT JOIN one a ON a.custom_id = r.custom_id),
ids AS (SELECT *, CASE WHEN json_valid(bare) THEN json_extract_string(bare, '$.results[*].entry') END AS found FROM got),
judged AS (SELECT custom_id, entries, prompt_tokens, completion_tokens, CASE WHEN status_code IS DISTINCT FROM 200 THEN 'non-200 response' WHEN choices IS DISTINCT FROM 1 OR finish_reason IS DISTINCT FROM 'stop' THEN 'missing normal stop'
  WHEN found IS NULL THEN 'invalid JSON result' WHEN len(found) <> len(list_distinct(found)) THEN 'duplicate result entry IDs' WHEN list_sort(list_distinct(found)) <> list_sort(list_distinct(entries)) THEN 'requested/result entry IDs differ'
  WHEN prompt_tokens IS NULL OR completion_tokens IS NULL THEN 'missing provider token usage' END AS reason FROM ids)"""


@query(f"{_SQL_JUDGED} SELECT custom_id, reason IS NULL AS accepted, reason, coalesce(prompt_tokens, 0) AS prompt_tokens FROM judged")
def validated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("custom_id", "accepted", "reason", F.coalesce("prompt_tokens", F.lit(0)).alias("prompt_tokens"))


@query(f"""{_SQL_JUDGED} SELECT reason AS error, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'duplicate response', (count(*) - count(DISTINCT custom_id))::BIGINT FROM answers HAVING count(*) > count(DISTINCT custom_id) UNION ALL SELECT 'response to no request', count(DISTINCT custom_id) FROM answers WHERE custom_id NOT IN (SELECT custom_id FROM requests) HAVING count(*) > 0""")
def response_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.response_errors(_requests(spark, sf_dir), _answers(spark, sf_dir), _judged(spark, sf_dir))


@query(f"{_SQL_JUDGED} SELECT count(*) AS requests, count(*) FILTER (reason IS NULL) AS accepted, sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, round((sum(prompt_tokens) * 0.5::DOUBLE + sum(completion_tokens) * 3.0::DOUBLE) / 1000000, 7) AS usd FROM judged")
def confirmed_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.confirmed_cost(_judged(spark, sf_dir))


@query(f"{_SQL_JUDGED} SELECT custom_id, pos, content FROM answers WHERE custom_id IN (SELECT custom_id FROM judged WHERE reason IS NULL)")
def accepted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.accepted_output(_answers(spark, sf_dir), _judged(spark, sf_dir)).select("custom_id", "pos", "content")


@query(f"{_SQL_JUDGED} SELECT 'repair-' || entry AS custom_id, custom_id AS source_custom_id, entry, reason FROM (SELECT custom_id, reason, unnest(entries) AS entry FROM judged WHERE reason IS NOT NULL)")
def repair_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.repair_requests(_judged(spark, sf_dir), "repair")


_STAGED = "SELECT source AS volume, doc_id AS id, doc_id AS ord, text, coalesce(n_chars % 5 = 0, false) AS partial FROM documents"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("volume"), F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "text", F.coalesce(F.col("n_chars") % 5 == 0, F.lit(False)).alias("partial"))


@query(f"SELECT volume, batch, entries, partial_tagged, volume || '-b' || lpad(CAST(batch AS VARCHAR), 4, '0') AS custom_id FROM (SELECT volume, batch, count(*) AS entries, count(*) FILTER (partial) AS partial_tagged FROM (SELECT *, (row_number() OVER (PARTITION BY volume ORDER BY ord, id) - 1) // 10 AS batch FROM ({_STAGED}) WHERE trim(text) <> '') GROUP BY volume, batch)")
def staged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.staged_batches(_records(spark, sf_dir)).drop("tail")


@plain
def token_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return S.token_report(records, S.staged_batches(records), 14_350)


@query("SELECT doc_id, strlen(coalesce(text, '')) + strlen(coalesce(lang, '')) + 256 AS ceiling FROM documents")
def input_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", S.input_ceiling(F.array(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")))).alias("ceiling"))


@plain
def spend_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as ledger events: some reserve, some settle the reservation before."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    kind = F.when(F.col("event_id") % 3 == 0, "settle").when(F.col("event_id") % 11 == 0, "release").otherwise("reserve")
    jobs = e.select(F.col("user_id").alias("ledger"), F.col("event_id").alias("pos"), F.concat(F.lit("j"), (F.col("event_id") % 4).cast("string")).alias("job"), kind.alias("kind"), F.round("value", 2).alias("amount"))
    return S.ledger(jobs, 500.0)


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, max(CASE WHEN value > 90 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS f FROM events) WHERE f = 0")
def run_until_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return S.before_first_failure(rows, "user_id", "event_id", F.col("value") > 90).select("user_id", "event_id")


@query("""WITH r AS (SELECT source AS volume, doc_id AS id, coalesce(n_chars % 5 = 0, false) AS partial FROM documents WHERE source IS NOT NULL), x AS (SELECT source AS volume, doc_id AS entry FROM documents JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id) WHERE source IS NOT NULL UNION ALL SELECT source, max(doc_id) + 1000000 FROM documents WHERE source IS NOT NULL GROUP BY source),
c AS (SELECT volume, count(*) AS corpus_records, count(*) FILTER (e IS NULL) AS missing_records, count(*) FILTER (e IS NOT NULL AND NOT partial) AS materialized_records, count(*) FILTER (e IS NOT NULL AND partial) AS partials_dropped FROM (SELECT r.*, x.entry AS e FROM r LEFT JOIN x ON x.volume = r.volume AND x.entry = r.id) GROUP BY volume)
SELECT *, 1::BIGINT AS provider_only_ids, 0::BIGINT AS invalid, CASE WHEN missing_records = corpus_records THEN 'no provider output yet' WHEN missing_records > 0 THEN 'PARTIAL' ELSE 'COMPLETE_WITH_REPAIRED_ANOMALIES' END AS state FROM c""")
def coverage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents stand for records with a result; each source has one result of no record."""
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").select(F.col("source").alias("volume"), F.col("doc_id").alias("id"), F.coalesce(F.col("n_chars") % 5 == 0, F.lit(False)).alias("partial"))
    labelled = docs.join(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).distinct(), "id").select("volume", F.col("id").alias("entry"))
    extra = docs.groupBy("volume").agg((F.max("id") + 1_000_000).alias("entry"))
    none = docs.select("volume").distinct().withColumn("invalid", F.lit(0).cast("bigint"))
    return S.coverage(docs, labelled.unionByName(extra), none)


@query("SELECT volume, entry, result, n - 1 AS repeats FROM (SELECT o_custkey % 10 AS volume, o_orderkey % 500 AS entry, arg_min(o_totalprice, o_orderkey) AS result, count(*) AS n FROM orders GROUP BY 1, 2)")
def first_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("volume"), (k % 500).alias("entry"), F.lit("a").alias("file"), k.alias("pos"), F.col("o_totalprice").alias("result"))
    return S.first_results(rows)


@query("""SELECT volume, count(*) AS n FROM (SELECT CASE WHEN c LIKE '%vocabtest%' THEN NULL ELSE nullif(regexp_extract(c, '(AUTO|BUILD|FURN)', 1), '') END AS volume FROM (SELECT left(c_mktsegment, 5) || CASE WHEN c_custkey % 7 = 0 THEN '-vocabtest-' ELSE '-b' END || c_custkey AS c FROM customer)) GROUP BY volume""")
def request_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments stand for volumes; every seventh request is an experiment."""
    c = F.concat(F.expr("left(c_mktsegment, 5)"), F.when(F.col("c_custkey") % 7 == 0, "-vocabtest-").otherwise("-b"), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select(routing.volume_of(c, ("AUTO", "BUILD", "FURN")).alias("volume")).groupBy("volume").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, count(*) AS delivered FROM documents WHERE NOT coalesce(n_chars % 5 = 0, false) GROUP BY lang")
def delivered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("lang", (F.col("n_chars") % 5 == 0).alias("partial"))
    return routing.delivered(rows).groupBy("lang").agg(F.count(F.lit(1)).alias("delivered"))


@plain
def matching_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty examples in English from one source or the other, chosen by a seed: a sample."""
    return routing.matching_examples(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), {"lang": "en"}, True, 30, "doc_id")


# --- cost: a made-up price list and token counts

_PRICES = [("large", 2.0, 0.2, 10.0, 0.5, 0.05, 4), ("middle", 1.0, 0.1, 5.0, 0.5, 0.25, 3), ("small", 0.1, 0.01, 0.4, 0.5, None, 1)]
_PARTS = {"sys_extract": 1500, "sys_normalize": 700, "instructions": 900, "shot_avg": 800, "n_shots": 15, "entry_in": 180, "entry_out": 420, "norm_in": 190, "norm_out": 180, "transcription_out": 450}
_COLUMNS = "model string, input double, cached double, output double, batch_mult double, cached_batch_mult double, quality int"


def _costs(spark: SparkSession) -> DataFrame:
    prices = spark.createDataFrame(_PRICES, _COLUMNS)
    parts = spark.range(1).select(*[F.lit(v).alias(k) for k, v in _PARTS.items()], F.lit(2.4173).alias("entries_per_image"))
    plans = K.recipes(prices.select("model"), prices.where("quality < 4").select("model"), (5, 15))
    return K.scenario_costs(plans, prices, parts)


_SQL_PRICES = ", ".join(f"('{m}', {i}::DOUBLE, {c}::DOUBLE, {o}::DOUBLE, {b}::DOUBLE, {'NULL' if s is None else s}::DOUBLE, {q})" for m, i, c, o, b, s, q in _PRICES)
_PASS = "((CASE WHEN cached THEN ({sys} + 900 + shots * 800) * r + (calls - 1) * ({sys} + 900 + shots * 800) * a ELSE calls * ({sys} + 900 + shots * 800) * r END) / 1e6 + e * ({given} + 20) * r / 1e6 + calls * 20 * batch * r / 1e6 + e * {said} * o / 1e6)"
_SQL_COSTS = f"""WITH prices AS (SELECT * FROM (VALUES {_SQL_PRICES}) AS t(model, input, hit, output, batch_mult, stacked, quality)),
plans AS (SELECT m.model, t.model AS trans_model, shots, cached, vendor_batch, batch, normalize FROM prices m, (SELECT model FROM prices WHERE quality < 4) t, (SELECT unnest([5, 15]) AS shots), (SELECT unnest([true, false]) AS cached), (SELECT unnest([true, false]) AS vendor_batch), (SELECT unnest([1, 5, 10, 20]) AS batch), (SELECT unnest(['separate', 'folded', 'none']) AS normalize)),
x AS (SELECT p.*, m.quality, 2.4173::DOUBLE * 300 AS e, ceil(2.4173::DOUBLE * 300 / greatest(1, batch)) AS calls, CASE WHEN vendor_batch THEN m.input * m.batch_mult ELSE m.input END AS r,
  CASE WHEN vendor_batch AND p.cached THEN m.input * coalesce(m.stacked, m.hit / m.input * m.batch_mult) WHEN p.cached THEN m.hit WHEN vendor_batch THEN m.input * m.batch_mult ELSE m.input END AS a,
  CASE WHEN vendor_batch THEN m.output * m.batch_mult ELSE m.output END AS o, CASE WHEN vendor_batch THEN t.input * t.batch_mult ELSE t.input END AS ti, CASE WHEN vendor_batch THEN t.output * t.batch_mult ELSE t.output END AS tout
  FROM plans p JOIN prices m ON m.model = p.model JOIN prices t ON t.model = p.trans_model),
y AS (SELECT *, ((1290 + 400) * ti + 450 * tout) / 1e6 * 300 AS t, CASE normalize WHEN 'separate' THEN {_PASS.format(sys=700, given=190, said=180)} WHEN 'folded' THEN e * 180 * o / 1e6 ELSE 0 END AS n, {_PASS.format(sys=1500, given=180, said=420)} AS x FROM x),
costs AS (SELECT model, trans_model, shots, cached, vendor_batch, batch, normalize, quality, round(t / 300, 5) AS transcription, round(n / 300, 5) AS normalization, round(x / 300, 5) AS extraction, round((x + n + t) / 300, 5) AS total, round((t + n) / 300, 5) AS transcription_plus_normalization FROM y)"""
_LEVERS = "model, trans_model, shots, cached, vendor_batch, batch, normalize"


@query(f"{_SQL_COSTS} SELECT * FROM costs")
def cost_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _costs(spark)


@query(f"""{_SQL_COSTS} SELECT {_LEVERS}, transcription_plus_normalization AS cost, row_number() OVER (ORDER BY transcription_plus_normalization, {_LEVERS})::INT AS rank,
row_number() OVER (ORDER BY CASE normalize WHEN 'folded' THEN 2 WHEN 'separate' THEN 1 ELSE 0 END + CASE WHEN cached THEN 2 ELSE 0 END + CASE WHEN batch >= 10 THEN 1 ELSE 0 END + quality DESC, transcription_plus_normalization, {_LEVERS}) = 1 AS recommended FROM costs WHERE transcription_plus_normalization <= 0.005::DOUBLE""")
def cost_optimizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.within_target(_costs(spark), 0.005).select(*K.ORDER, F.col("transcription_plus_normalization").alias("cost"), "rank", "recommended")


@query(f"{_SQL_COSTS} SELECT {_LEVERS}, quality, total, total > 0.01::DOUBLE AS over_budget FROM costs ORDER BY over_budget, quality DESC, total, {_LEVERS} LIMIT 1")
def cost_best_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one recipe that is recommended."""
    return K.best_quality(_costs(spark)).select(*K.ORDER, "quality", "total", "over_budget")


_STEPS = (("baseline", 15, False, 1, "separate"), ("cache", 15, True, 1, "separate"), ("batch of 10", 15, True, 10, "separate"), ("folded", 15, True, 10, "folded"), ("5 shots", 5, True, 10, "folded"))
_SQL_STEPS = ", ".join(f"({i}, '{n}', {s}, {str(c).lower()}, {b}, '{z}')" for i, (n, s, c, b, z) in enumerate(_STEPS))


@query(f"""{_SQL_COSTS}, steps AS (SELECT * FROM (VALUES {_SQL_STEPS}) AS t(pos, label, shots, cached, batch, normalize)) SELECT pos, label, transcription_plus_normalization AS trans_norm, total, round(lag(total) OVER (ORDER BY pos) - total, 5) AS saved, round(total * 750000, 2) AS corpus_usd
FROM steps JOIN costs USING (shots, cached, batch, normalize) WHERE model = 'middle' AND trans_model = 'small' AND NOT vendor_batch""")
def cost_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = spark.createDataFrame([(i, *s) for i, s in enumerate(_STEPS)], "pos int, label string, shots int, cached boolean, batch int, normalize string")
    costs = _costs(spark).where("model = 'middle' AND trans_model = 'small' AND NOT vendor_batch")
    return K.corpus_total(K.waterfall(steps.join(costs, ["shots", "cached", "batch", "normalize"])), 750_000)


@query("SELECT event_id, usd, spent FROM (SELECT event_id, usd, round(sum(usd::DECIMAL(20,9)) OVER (ORDER BY event_id)::DOUBLE, 9) AS spent FROM (SELECT event_id, round((event_id % 900 * 1.0::DOUBLE + event_id % 70 * 5.0::DOUBLE) / 1e6, 9) AS usd FROM events)) WHERE spent - usd < 1.5")
def run_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of a run until its cap is reached."""
    k = F.col("event_id")
    calls = table(spark, sf_dir, "events").select(k.alias("pos"), (k % 900).alias("prompt_tokens"), (k % 70).alias("completion_tokens"))
    return K.run_costs(calls, 1.0, 5.0, 1.5).select(F.col("pos").alias("event_id"), "usd", "spent")
