"""Requests to a model and what comes back: batches, token counts, validation, ledger, repair, assembly.

No provider is called here: requests leave as rows and answers come in as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import token_estimate

# The note on cut records, prices a million tokens of a batch, output tokens an entry, the frame of a message.
CUT_NOTE = "\n[NOTE: entry may be truncated at a page/volume boundary]"
INPUT_PRICE, OUTPUT_PRICE = 0.5, 3.0
OUTPUT_EACH, MESSAGE_FRAME = 900, 128
RESULTS = "array<struct<entry:string,normalized:string,data:string>>"


def staged_batches(records: DataFrame, size: int = 10) -> DataFrame:
    """volume, batch, custom_id, entries, partial_tagged and tail (JSON of the batch's entries); blank records are not sent.

    records: volume, id, ord, text, partial. The shared prefix of messages is stored once a volume, not here.
    """
    text = F.concat("text", F.when(F.coalesce("partial", F.lit(False)), CUT_NOTE).otherwise(""))
    kept = records.where(F.trim("text") != "").select("volume", "id", "ord", text.alias("text"), F.coalesce("partial", F.lit(False)).alias("partial"))
    numbered = kept.withColumn("batch", F.floor((F.row_number().over(W.partitionBy("volume").orderBy("ord", "id")) - 1) / size))
    rows = numbered.groupBy("volume", "batch").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if("partial").alias("partial_tagged"),
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id", "text"))), lambda x: F.struct(x["id"].alias("entry"), x["text"].alias("transcription")))).alias("tail"),
    )
    digits = F.col("batch").cast("string")
    return rows.withColumn("custom_id", F.concat(F.col("volume").cast("string"), F.lit("-b"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))))


def staging_totals(batches: DataFrame, prefix_tokens: int) -> DataFrame:
    """entries, partial_tagged, calls and input_tokens_nocache of each volume."""
    return batches.groupBy("volume").agg(
        F.sum("entries").alias("entries"), F.sum("partial_tagged").alias("partial_tagged"), F.count(F.lit(1)).alias("calls"),
        (F.count(F.lit(1)) * prefix_tokens + F.sum(token_estimate(F.col("tail")))).alias("input_tokens_nocache"),
    )


def token_report(records: DataFrame, batches: DataFrame, prefix_tokens: int, frame: int = 30) -> DataFrame:
    """Input tokens of a volume if each entry were a call of its own, and in batches."""
    alone = records.where(F.trim("text") != "").groupBy("volume").agg(F.count(F.lit(1)).alias("n"), F.sum(token_estimate(F.col("text"))).alias("t"))
    both = alone.join(staging_totals(batches, prefix_tokens).select("volume", F.col("input_tokens_nocache").alias("batched_input_tokens")), "volume")
    per_entry = F.col("n") * (prefix_tokens + F.floor(F.col("t") / F.col("n")) + frame)
    return both.select("volume", F.col("n").alias("entries"), per_entry.alias("per_entry_input_tokens"), "batched_input_tokens", F.round(per_entry / F.greatest(F.lit(1), F.col("batched_input_tokens")), 2).alias("input_reduction_x"))


def input_ceiling(messages: Column) -> Column:
    """No request has more input tokens than its messages have bytes, plus a frame each."""
    return F.aggregate(messages, F.lit(0).cast("bigint"), lambda a, m: a + F.octet_length(m) + MESSAGE_FRAME)


def parsed_results(content: Column) -> Column:
    """Results of a model's answer: code fences off; an object's ``results``, or a bare list, or the outermost object in the text; null if none is found."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(content), r"(?i)^```(json)?", ""), r"```$", ""))
    braced = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    whole = F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.nullif(braced, F.lit(""))))
    items = F.coalesce(F.try_variant_get(whole, "$.results", "array<variant>"), F.try_variant_get(whole, "$", "array<variant>"))
    field = lambda v, name: F.try_variant_get(v, f"$.{name}", "string")
    return F.transform(items, lambda v: F.struct(field(v, "entry").alias("entry"), field(v, "normalized").alias("normalized"), field(v, "data").alias("data")))


def validated(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """A row a request: custom_id, accepted, reason (of the first rule it breaks), prompt_tokens, completion_tokens, results.

    requests: custom_id and entries (array of ids); responses: custom_id, pos, status_code, choices (their number), finish_reason,
    content, prompt_tokens, completion_tokens. Of several responses to a request the first counts.
    """
    first = responses.withColumn("_n", F.row_number().over(W.partitionBy("custom_id").orderBy("pos"))).where("_n = 1").drop("_n", "pos")
    both = requests.join(first, "custom_id", "left").withColumn("results", parsed_results(F.col("content")))
    ids = F.transform("results", lambda r: r["entry"])
    reason = (
        F.when(~F.coalesce(F.col("status_code") == 200, F.lit(False)), "non-200 response")
        .when(~F.coalesce((F.col("choices") == 1) & (F.col("finish_reason") == "stop"), F.lit(False)), "missing normal stop")
        .when(F.col("results").isNull(), "invalid JSON result").when(F.size(ids) != F.size(F.array_distinct(ids)), "duplicate result entry IDs")
        .when(F.array_sort(F.array_distinct(ids)) != F.array_sort(F.array_distinct(F.col("entries"))), "requested/result entry IDs differ")
        .when(F.col("prompt_tokens").isNull() | F.col("completion_tokens").isNull(), "missing provider token usage")
    )
    return both.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull()).select("custom_id", "entries", "accepted", "reason", "prompt_tokens", "completion_tokens", "results")


def response_errors(requests: DataFrame, responses: DataFrame, judged: DataFrame) -> DataFrame:
    """error and n: reasons of rejection, responses to the same request again, and responses to none."""
    again = responses.groupBy("custom_id").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).where("n > 0")
    unknown = responses.join(requests.select("custom_id"), "custom_id", "left_anti").agg(F.countDistinct("custom_id").alias("n")).where("n > 0")
    rejected = judged.where("NOT accepted").groupBy(F.col("reason").alias("error")).agg(F.count(F.lit(1)).alias("n"))
    return rejected.unionByName(again.select(F.lit("duplicate response").alias("error"), "n")).unionByName(unknown.select(F.lit("response to no request").alias("error"), "n"))


def confirmed_cost(judged: DataFrame) -> DataFrame:
    """requests, accepted, tokens and their price."""
    sums = judged.agg(F.count(F.lit(1)).alias("requests"), F.count_if("accepted").alias("accepted"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"))
    return sums.withColumn("usd", F.round((F.col("prompt_tokens") * INPUT_PRICE + F.col("completion_tokens") * OUTPUT_PRICE) / 1e6, 7))


def accepted_output(responses: DataFrame, judged: DataFrame) -> DataFrame:
    """The responses to requests that passed every check; raw output is kept elsewhere."""
    return responses.join(judged.where("accepted").select("custom_id"), "custom_id", "left_semi")


def repair_requests(judged: DataFrame, label: str) -> DataFrame:
    """A request of one entry for each entry of a rejected request: custom_id, source_custom_id, entry, reason; a repeated entry is asked for once."""
    each = judged.where("NOT accepted").select(F.col("custom_id").alias("source_custom_id"), "reason", F.explode("entries").alias("entry"))
    once = each.groupBy("entry").agg(F.min_by("source_custom_id", "source_custom_id").alias("source_custom_id"), F.min_by("reason", "source_custom_id").alias("reason"))
    return once.select(F.concat(F.lit(f"{label}-"), "entry").alias("custom_id"), "source_custom_id", "entry", "reason")


def ledger(jobs: DataFrame, cap: float, group: str = "ledger") -> DataFrame:
    """What a ledger says after each event, in order: confirmed, reserved, remaining, and whether a reservation was granted.

    jobs: ledger, pos, job, kind (reserve, settle or release), amount; a settle gives what was spent, and frees the job's own
    reservation. A reservation beyond what remains is refused and holds nothing; settling or releasing a refused job does
    nothing. Each decision depends on those before it, so that a ledger's few rows are folded in order within their group.
    """
    import pyarrow as pa

    kind = jobs.schema[group].dataType.simpleString()

    def fold(part: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        confirmed = reserved = 0
        held: dict[str, int] = {}
        out = []
        for job, what, amount in zip(part["job"].to_pylist(), part["kind"].to_pylist(), part["amount"].to_pylist(), strict=True):
            cents = round((amount or 0.0) * 10**7)
            granted = None
            if what == "reserve":
                granted = cents <= round(cap * 10**7) - confirmed - reserved and job not in held
                if granted:
                    held[job], reserved = cents, reserved + cents
            elif job in held:
                reserved -= held.pop(job)
                confirmed += cents if what == "settle" else 0
            out.append((granted, confirmed / 10**7, reserved / 10**7, round(cap - (confirmed + reserved) / 10**7, 7)))
        columns = [pa.array([x[i] for x in out], pa.bool_() if i == 0 else pa.float64()) for i in range(4)]
        return pa.table([part[group], part["pos"], part["job"], part["kind"], *columns], names=[group, "pos", "job", "kind", "granted", "confirmed", "reserved", "remaining"])

    return jobs.select(group, "pos", "job", "kind", F.col("amount").cast("double").alias("amount")).groupBy(group).applyInArrow(fold, f"{group} {kind}, pos bigint, job string, kind string, granted boolean, confirmed double, reserved double, remaining double")


def unsent(requests: DataFrame, sent: DataFrame, take: int) -> DataFrame:
    """The next ``take`` requests, by id, that no job has sent: a limit that is the feature."""
    return requests.join(sent.select("custom_id").distinct(), "custom_id", "left_anti").orderBy("custom_id").limit(take)


def before_first_failure(rows: DataFrame, group: str, order: str, failed: Column) -> DataFrame:
    """Rows of each group before the first that failed: a run stops there."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn("_f", F.max(F.coalesce(failed, F.lit(True)).cast("int")).over(w)).where("_f = 0").drop("_f")


def first_results(accepted: DataFrame) -> DataFrame:
    """volume, entry and result of accepted rows (volume, file, pos, entry, result), the first by file and place; and how many repeat it."""
    return accepted.groupBy("volume", "entry").agg(F.min_by("result", F.struct("file", "pos")).alias("result"), (F.count(F.lit(1)) - 1).alias("repeats"))


def coverage(records: DataFrame, results: DataFrame, anomalies: DataFrame) -> DataFrame:
    """corpus, materialized, missing and provider-only records of each volume, dropped partials, invalid rows and its state.

    records: volume, id, partial; results: volume, entry; anomalies: volume, invalid (their number).
    """
    r = records.join(results.select("volume", F.col("entry").alias("id")).distinct().withColumn("_x", F.lit(True)), ["volume", "id"], "left")
    counts = r.groupBy("volume").agg(
        F.count(F.lit(1)).alias("corpus_records"), F.count_if(F.expr("_x IS NULL")).alias("missing_records"), F.count_if(F.expr("_x AND NOT coalesce(partial, false)")).alias("materialized_records"), F.count_if(F.expr("_x AND partial")).alias("partials_dropped")
    )
    extra = results.join(records.select("volume", F.col("id").alias("entry")), ["volume", "entry"], "left_anti").groupBy("volume").agg(F.countDistinct("entry").alias("provider_only_ids"))
    out = counts.join(extra, "volume", "left").join(anomalies, "volume", "left").fillna(0, ["provider_only_ids", "invalid"])
    none = F.col("missing_records") == F.col("corpus_records")
    state = F.when(none, "no provider output yet").when(F.col("missing_records") > 0, "PARTIAL").when(F.col("invalid") + F.col("provider_only_ids") > 0, "COMPLETE_WITH_REPAIRED_ANOMALIES").otherwise("COMPLETE")
    return out.withColumn("state", state)


def checked_materialization(records: DataFrame, results: DataFrame) -> DataFrame:
    """records with their results; fails if results name a record that is not there."""
    extra = results.join(records.select(F.col("id").alias("entry"), "volume"), ["volume", "entry"], "left_anti")
    if (row := extra.select("volume", "entry").first()) is not None:
        raise ValueError(f"a result names no record: {row.volume} {row.entry}")
    return records.join(results.withColumnRenamed("entry", "id"), ["volume", "id"])


def deduplicated(entries: DataFrame, group: str, text: str, order: Column) -> DataFrame:
    """Of entries of a group with the same text, white space and case aside, the first by ``order``; whole texts by their SHA-256."""
    key = F.sha2(F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", " "))), 256)
    return entries.withColumn("_n", F.row_number().over(W.partitionBy(group, key).orderBy(order))).where("_n = 1").drop("_n")


def renumbered(entries: DataFrame, group: str, page: str, order: Column) -> DataFrame:
    """entries with id: the first page and a running number in order."""
    n = F.row_number().over(W.partitionBy(group, page).orderBy(order)).cast("string")
    return entries.withColumn("id", F.concat(F.coalesce(F.col(page), F.lit("0000")), F.lit("-"), F.lpad(n, F.greatest(F.lit(2), F.length(n)), F.lit("0"))))
