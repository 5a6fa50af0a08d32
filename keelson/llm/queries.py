"""The registered queries of the training-data operators."""

from __future__ import annotations

from keelson.llm import (
    decontaminate,
    filter_audit,
    fingerprints,
    langid,
    learned_partitions,
    licenses,
    mixing,
    ngram_join,
    sampling,
    sharding,
    token_alignment,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_url_filter": url_filter.query,
    "op2_ngram_jaccard_join": ngram_join.query,
    "op3_licenses": licenses.query,
    "op4_toxicity": toxicity.query,
    "op5_sharding": sharding.query,
    "op6_language_id": langid.query,
    "op7_importance_resampling": sampling.query,
    "op8_mixing": mixing.query,
    "op9_decontamination": decontaminate.query,
    "op10_fingerprints": fingerprints.query,
    "op11_filter_audit": filter_audit.query,
    "op12_learned_partitions": learned_partitions.query,
    "op13_token_alignment": token_alignment.query,
}
