"""The registered queries of the training-text operators, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (conversations, decontaminate, langid, manifest, mixing, pii, quality, repeats, secrets,
                         simhash, tokens, topk, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_warc_fixity": warc.op2_warc_fixity,
    "op3_language_id": langid.op3_language_id,
    "op4_pii_anchors": pii.op4_pii_anchors,
    "op5_repeat_index": repeats.op5_repeat_index,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_benchmark_tiling": decontaminate.op7_benchmark_tiling,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_token_records": tokens.op9_token_records,
    "op10_source_mix": mixing.op10_source_mix,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_exact_topk": topk.op12_exact_topk,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op2_warc_fixity": warc.OP2_SQL,
    "op5_repeat_index": repeats.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op8_secret_scan": secrets.OP8_SQL,
    "op10_source_mix": mixing.OP10_SQL,
    "op12_exact_topk": topk.OP12_SQL,
    "op13_merkle_manifest": manifest.OP13_SQL,
}
