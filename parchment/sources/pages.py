"""Readers of page exports and writers of record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A flat page of a JSON export, and a volume item that holds several.
PAGE = "struct<file:string,image_caption:string,transcription:string>"
ITEM = f"title string, images array<{PAGE}>, metadata map<string,string>"


def read_items(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A page for each image of a volume's items: volume (path), item and page from 1, title and the page's fields; items without images give none."""
    items = spark.read.schema(ITEM).json(path, multiLine=multiline).select(F.input_file_name().alias("volume"), "title", "images", F.monotonically_increasing_id().alias("item"))
    return items.select("volume", "item", "title", F.posexplode("images").alias("_p", "_i")).select("volume", "item", "title", (F.col("_p") + 1).alias("page"), "_i.*")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Pages of Markdown exports, split at their headings by the reader itself; text before the first heading is no page."""
    raw = spark.read.option("lineSep", "\n### ").text(path)
    part = lambda p: F.regexp_extract("value", p, 1)
    lines = F.transform(F.split(part(r"(?s)- \*\*transcription\*\*:[ \t]*\n?(.*)"), "\n"), lambda x: F.trim(x))
    return raw.where(F.col("value").contains("- **transcription**:")).select(
        F.trim(part(r"^(?:### )?([^\n]*)")).alias("file"),
        F.trim(part(r"- \*\*image_caption\*\*:([^\n]*)")).alias("image_caption"),
        F.trim(F.array_join(lines, "\n"), F.lit("\n")).alias("transcription"),
    )


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Flat columns, quoted so that line breaks and quotes in names survive."""
    rows.write.mode("errorifexists").csv(path, header=True, quote='"', escape='"')


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of exports in any of their shapes: volume, page_no, image, text, in order; blank transcriptions are no pages.

    A file holds a list of items with images, a flat list of pages, or one page; .md files are Markdown exports. A page without
    a name is called by its place among the pages kept.
    """
    if path.lower().endswith(".md"):
        whole = spark.read.text(path, wholetext=True)
        blocks = F.regexp_extract_all("value", F.lit(r"(?s)###\s+(\S+.*?)(?=###\s+\S+|\z)"), F.lit(1))
        each = whole.select(F.input_file_name().alias("volume"), F.posexplode(blocks).alias("at", "block"))
        body = F.regexp_extract("block", r"(?s)\*\*transcription\*\*:\s*\n(.*?)(?=\n-\s+\*\*|\z)", 1)
        lines = F.array_join(F.transform(F.split(body, r"\r\n|\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), "\n")
        rows = each.where(F.col("block").rlike(r"\*\*transcription\*\*:\s*\n")).select("volume", "at", F.lit(0).alias("inner"), F.regexp_extract("block", r"^(\S+)", 1).alias("image"), F.regexp_replace(lines, r"(?U)^\s+|\s+$", "").alias("text"))
    else:
        whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("volume"), F.try_parse_json("value").alias("v"))
        items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
        each = whole.select("volume", F.posexplode(items).alias("at", "item"))
        own = F.try_variant_get("item", "$.transcription", "string")
        images = F.when(own.isNotNull(), F.array("item")).otherwise(F.try_variant_get("item", "$.images", "array<variant>"))
        parts = each.select("volume", "at", F.posexplode(images).alias("inner", "page"))
        rows = parts.select("volume", "at", "inner", F.try_variant_get("page", "$.file", "string").alias("image"), F.try_variant_get("page", "$.transcription", "string").alias("text"))
        rows = rows.where(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s", "") != "")
    n = F.row_number().over(W.partitionBy("volume").orderBy("at", "inner"))
    return rows.select("volume", n.cast("bigint").alias("page_no"), F.coalesce("image", F.concat(F.lit("page"), (n - 1).cast("string"), F.lit(".jpg"))).alias("image"), "text")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Extracted entries of volume files: volume, ord, entry, text, people and events as JSON; rows stand under entries, examples or records."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("volume"), F.try_parse_json("value").alias("v"))
    rows = F.coalesce(*[F.try_variant_get("v", p, "array<variant>") for p in ("$.entries", "$.examples", "$.records", "$")])
    get = lambda p: F.try_variant_get("e", p, "string")
    return whole.select("volume", F.posexplode(rows).alias("ord", "e")).select(
        "volume", "ord", F.coalesce(get("$.entry"), get("$.id"), F.lit("")).alias("entry"), F.coalesce(F.nullif(get("$.normalized"), F.lit("")), get("$.raw"), F.lit("")).alias("text"),
        F.to_json(F.try_variant_get("e", "$.data.people", "array<variant>")).alias("people"), F.to_json(F.try_variant_get("e", "$.data.events", "array<variant>")).alias("events"),
    )


def read_batches(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Headers (volume, header) and requests (volume, pos, custom_id, tail) of compact batch files; fails on a file without a header, requests or ids."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.input_file_name().alias("volume"), "value", F.get_json_object("value", "$.header").alias("header"))
    headers = lines.where("header IS NOT NULL").select("volume", "header")
    requests = lines.where("header IS NULL").select("volume", F.get_json_object("value", "$.custom_id").alias("custom_id"), F.get_json_object("value", "$.tail_message").alias("tail"))
    bad = lines.groupBy("volume").agg(F.count("header").alias("h"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("header").isNull() & F.get_json_object("value", "$.custom_id").isNull()).alias("nameless")).where("h <> 1 OR n < 2 OR nameless > 0")
    if (row := bad.first()) is not None:
        raise ValueError(f"not a compact batch file: {row.volume}")
    return headers, requests


def expanded_requests(headers: DataFrame, requests: DataFrame, most_output: int = 9000) -> DataFrame:
    """volume, custom_id and the request line in full: the volume's prefix messages and the request's own, as JSON."""
    prefix = F.from_json(F.get_json_object("header", "$.prefix_messages"), "array<map<string,string>>")
    both = requests.join(headers.select("volume", prefix.alias("prefix"), F.get_json_object("header", "$.model").alias("model")), "volume")
    messages = F.concat("prefix", F.array(F.from_json("tail", "map<string,string>")))
    body = F.struct("model", messages.alias("messages"), F.struct(F.lit("json_object").alias("type")).alias("response_format"), F.lit(most_output).alias("max_completion_tokens"))
    return both.select("volume", "custom_id", F.to_json(F.struct("custom_id", F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))).alias("line"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Provider answers from JSONL files: file, custom_id, status_code, choices, finish_reason, content, prompt_tokens, completion_tokens."""
    get = lambda p: F.get_json_object("value", p)
    body = "$.response.body"
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.input_file_name().alias("file"), get("$.custom_id").alias("custom_id"), get("$.response.status_code").try_cast("int").alias("status_code"),
        F.coalesce(F.json_array_length(get(f"{body}.choices")), F.lit(0)).alias("choices"), get(f"{body}.choices[0].finish_reason").alias("finish_reason"), get(f"{body}.choices[0].message.content").alias("content"),
        get(f"{body}.usage.prompt_tokens").try_cast("bigint").alias("prompt_tokens"), get(f"{body}.usage.completion_tokens").try_cast("bigint").alias("completion_tokens"),
    )


def volume_facts(items: DataFrame) -> DataFrame:
    """volume, title (the first that is not blank, else Untitled volume) and identifier (the first in the metadata, else the number in the path)."""
    first = lambda c: F.min_by(c, F.when(F.trim(c) != "", F.col("item")))
    rows = items.withColumn("_id", F.col("metadata")["identifier"])
    facts = rows.groupBy("volume").agg(first("title").alias("title"), first("_id").alias("identifier"))
    return facts.select("volume", F.coalesce("title", F.lit("Untitled volume")).alias("title"), F.coalesce("identifier", F.nullif(F.regexp_extract("volume", r"([0-9]{4,})[^/]*$", 1), F.lit(""))).alias("identifier"))


def training_rows(records: DataFrame, metadata: dict[str, str]) -> DataFrame:
    """Entries of a processed volume as training examples: each with the volume's metadata, missing text as empty and missing data as an empty object."""
    return records.select(
        "entry", F.coalesce("raw", F.lit("")).alias("raw"), F.coalesce("normalized", F.lit("")).alias("normalized"), F.coalesce("data", F.lit("{}")).alias("data"), *[F.lit(v).alias(k) for k, v in metadata.items()]
    )


def review_page(rows: DataFrame, title: str, most: int) -> str:
    """A self-contained HTML page with up to ``most`` rows for a reviewer, as JSON that cannot end its script early."""
    import html

    data = "[" + ",".join(r for r in rows.limit(most).toJSON().collect()) + "]"
    safe = data.replace("<", "\\u003c")
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><div id='list'></div><script>const rows = {safe};\nconst list = document.getElementById('list');\nfor (const r of rows) {{ const p = document.createElement('pre'); p.textContent = JSON.stringify(r, null, 1); list.appendChild(p); }}\n</script></body></html>"
