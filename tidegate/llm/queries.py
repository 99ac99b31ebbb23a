"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import (
    alignment,
    bpe,
    decontaminate,
    licenses,
    line_dedup,
    pii,
    quality,
    ranked,
    simhash,
    token_files,
    topk,
    url_filter,
    warc,
)
from tidegate.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k_search": lambda s, d: topk.report(table(s, d, "embeddings")),
    "op2_decontamination": lambda s, d: decontaminate.report(table(s, d, "documents"), table(s, d, "benchmark")),
    "op3_quality_classifier": lambda s, d: quality.report(table(s, d, "documents"), table(s, d, "labels")),
    "op4_simhash": lambda s, d: simhash.report(table(s, d, "documents")),
    "op5_url_filters": lambda s, d: url_filter.judge(table(s, d, "pages"), url_filter.rule_frame(s)),
    "op6_line_dedup": lambda s, d: line_dedup.report(table(s, d, "documents")),
    "op7_bpe_round_trip": lambda s, d: bpe.round_trip(table(s, d, "documents"), BYTE_BPE),
    "op8_token_files": lambda s, d: token_files.written_and_read(table(s, d, "documents"), WORD_BPE),
    "op9_pii": lambda s, d: pii.report(table(s, d, "documents")),
    "op10_license_scans": lambda s, d: licenses.report(
        table(s, d, "documents"), licenses.sentence_frame(s), licenses.rule_frame(s)
    ),
    "op11_warc": lambda s, d: warc.report(table(s, d, "pages")),
    "op12_ranked_search": lambda s, d: ranked.search(table(s, d, "documents"), table(s, d, "benchmark")),
    "op13_alignment": lambda s, d: alignment.report(table(s, d, "documents"), BYTE_BPE, PIECE_BPE),
}
