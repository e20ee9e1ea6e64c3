"""The registered training-data queries and, where SQL can say it, the statements that check them."""

from __future__ import annotations

import corpus_pipeline
from tidemill.llm import (
    conversations,
    exact_dedup,
    fingerprints,
    langid,
    merkle,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup.op1_exact_dedup,
        mixing.op2_mix_sources,
        fingerprints.op3_fingerprints,
        suffix_dedup.op4_suffix_dedup,
        secrets.op5_secret_scan,
        toxicity.op6_toxicity,
        pii.op7_pii_surrogates,
        packing.op8_pack_sequences,
        langid.op9_language_id,
        ngram_join.op10_ngram_join,
        merkle.op11_merkle_manifest,
        conversations.op12_conversation_repair,
        quality.op13_quality,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {"op1_exact_dedup": exact_dedup.ORACLE_SQL, "op11_merkle_manifest": merkle.ORACLE_SQL}
