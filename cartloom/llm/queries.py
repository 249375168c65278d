"""Registry of this subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartloom.llm.ann import op7_ann
from cartloom.llm.decontaminate import OP6_SQL, op6_decontamination
from cartloom.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from cartloom.llm.language_id import op1_language_id
from cartloom.llm.mixing import op4_mixing
from cartloom.llm.ngram_join import op2_ngram_jaccard
from cartloom.llm.secret_scan import OP13_SQL, op13_secret_scan
from cartloom.llm.substring_dedup import OP10_SQL, op10_substring_dedup
from cartloom.llm.suffix_dedup import op9_suffix_dedup
from cartloom.llm.token_alignment import op12_token_alignment
from cartloom.llm.toxicity import op8_toxicity
from cartloom.llm.url_filter import op5_url_filter
from cartloom.llm.warc import OP3_SQL, op3_warc


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over its whole table."""
    return {
        "op1_language_id": op1_language_id,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_warc": op3_warc,
        "op4_mixing": op4_mixing,
        "op5_url_filter": op5_url_filter,
        "op6_decontamination": op6_decontamination,
        "op7_ann": op7_ann,
        "op8_toxicity": op8_toxicity,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_token_alignment": op12_token_alignment,
        "op13_secret_scan": op13_secret_scan,
    }


def oracle_queries() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op3_warc": OP3_SQL, "op6_decontamination": OP6_SQL,
            "op10_substring_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL,
            "op13_secret_scan": OP13_SQL}
