"""Registered queries of this subpackage and their DuckDB statements where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm.adaptive import op10_adaptive_rules
from lakeshift.llm.conversations import op11_conversation_repair
from lakeshift.llm.decontam import op8_decontamination
from lakeshift.llm.langid import op6_language_id
from lakeshift.llm.line_templates import op4_line_dedup
from lakeshift.llm.minhash import op3_near_dedup
from lakeshift.llm.mixing import op1_mixture
from lakeshift.llm.oracle import SQL
from lakeshift.llm.phrases import op12_phrases
from lakeshift.llm.quality import op5_quality_classifier
from lakeshift.llm.records import op7_token_records
from lakeshift.llm.substring import op2_substring_dedup
from lakeshift.llm.tokencount import op9_token_counts
from lakeshift.llm.warc import op13_warc

QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_mixture, op2_substring_dedup, op3_near_dedup, op4_line_dedup, op5_quality_classifier,
    op6_language_id, op7_token_records, op8_decontamination, op9_token_counts, op10_adaptive_rules,
    op11_conversation_repair, op12_phrases, op13_warc,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
