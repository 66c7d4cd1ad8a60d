"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raillark.llm import decontamination, fill_in_middle, vector_codes
from raillark.llm.co_training import op4_co_training_quality
from raillark.llm.decontamination import op13_decontamination
from raillark.llm.fill_in_middle import op12_fill_in_middle
from raillark.llm.fingerprints import op5_scaled_sketch
from raillark.llm.line_dedup import op3_line_set_join
from raillark.llm.near_dedup import op7_minhash_near_dedup
from raillark.llm.packing import op9_best_fit_packing
from raillark.llm.quality_rules import op1_distribution_rules
from raillark.llm.token_counts import op8_token_counts
from raillark.llm.toxicity import op2_conv_toxicity
from raillark.llm.vector_codes import op11_vector_codes
from raillark.llm.viterbi import op6_piece_encoding
from raillark.llm.warc_zstd import op10_warc_zstd

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_distribution_rules": op1_distribution_rules,
    "op2_conv_toxicity": op2_conv_toxicity,
    "op3_line_set_join": op3_line_set_join,
    "op4_co_training_quality": op4_co_training_quality,
    "op5_scaled_sketch": op5_scaled_sketch,
    "op6_piece_encoding": op6_piece_encoding,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_warc_zstd": op10_warc_zstd,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_decontamination": op13_decontamination,
}

_PAGES = "SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages"

#: The others need a tokenizer, a trained model, hashes of their own or too long a time in SQL; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op10_warc_zstd": f"SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM ({_PAGES}))",
    "op11_vector_codes": vector_codes.oracle(),
    "op12_fill_in_middle": fill_in_middle.ORACLE,
    "op13_decontamination": decontamination.ORACLE,
}
