"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skein.llm.chat import OP1_SQL, op1_chat_preferences
from skein.llm.decontamination import op6_decontamination
from skein.llm.language_id import op7_language_id
from skein.llm.license_scan import op8_license_scan
from skein.llm.lm_scoring import op9_lm_scoring
from skein.llm.packing import op2_packing
from skein.llm.simhash_dedup import op5_simhash_dedup
from skein.llm.sketches import op10_fingerprints
from skein.llm.token_counts import op4_token_counts
from skein.llm.toxicity import op3_toxicity


def text_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op4: its bytes."""
    return op4_token_counts(spark, sf_dir).select("doc_id", "n_bytes")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of op10: lengths and edited texts."""
    return op10_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


TEXT_BYTES_SQL = "SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes FROM documents"

EDITED_SQL = """
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
beside AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first(text) OVER (ORDER BY doc_id DESC)) AS after FROM rows)
SELECT doc_id, n AS n_chars, sha256(substr(text, 1, n - n // 3) || substr(after, 1, n // 3)) AS edited_sha256 FROM beside
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_preferences": op1_chat_preferences,
        "op2_packing": op2_packing,
        "op3_toxicity": op3_toxicity,
        "op4_token_counts": op4_token_counts,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_decontamination": op6_decontamination,
        "op7_language_id": op7_language_id,
        "op8_license_scan": op8_license_scan,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_fingerprints": op10_fingerprints,
        "text_bytes": text_bytes,
        "edited_texts": edited_texts,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_preferences": OP1_SQL, "text_bytes": TEXT_BYTES_SQL, "edited_texts": EDITED_SQL}
