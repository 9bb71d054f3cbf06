"""The subpackage's queries and their SQL."""

from __future__ import annotations

from . import ann, bpe, counts, mixing, neardup, quality, substrings, suffixes, tokenfile, urlfilter

QUERIES = {f.__name__: f for f in (urlfilter.op1_url_filters, urlfilter.op1_url_filters_by_level, bpe.op2_byte_bpe, tokenfile.op3_token_files, counts.op4_token_counts, substrings.op5_substring_dedup, quality.op6_quality_rules, ann.op7_nearest_neighbours, neardup.op8_minhash_near_dedup, mixing.op9_source_mixing, suffixes.op10_suffix_dedup)}
ORACLES = {"op1_url_filters": urlfilter.ORACLE, "op5_substring_dedup": substrings.ORACLE, "op6_quality_rules": quality.ORACLE, "op9_source_mixing": mixing.ORACLE}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
