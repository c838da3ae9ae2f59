"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.llm.conversations import op11_conversations
from silverline.llm.fingerprint import op7_fingerprint
from silverline.llm.langid import op2_language
from silverline.llm.licenses import op10_licenses
from silverline.llm.lmscore import op13_lm
from silverline.llm.mixing import op9_mixing
from silverline.llm.packing import op1_packing
from silverline.llm.pii import op5_pii
from silverline.llm.quality import op4_quality
from silverline.llm.sharding import op8_sharding
from silverline.llm.simhash import op3_simhash
from silverline.llm.spelling import op12_spelling
from silverline.llm.toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_fingerprint": op7_fingerprint,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_conversations": op11_conversations,
    "op12_spelling": op12_spelling,
    "op13_lm": op13_lm,
}

#: Operators that SQL can't express are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {}
