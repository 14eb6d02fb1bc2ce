"""The queries of this subpackage, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ann, filter_audit, importance, mixing, packing, pipeline, records, sampling_fingerprints, secrets, sharding, simhash, suffix_dedup, toxicity, window_dedup

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_packing": packing.query,
    "op3_secrets": secrets.query,
    "op4_sharding": sharding.query,
    "op5_records": records.query,
    "op6_simhash": simhash.query,
    "op7_weighted_sampling": sampling_fingerprints.query,
    "op8_ann": ann.query,
    "op9_toxicity": toxicity.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_importance": importance.query,
    "op12_filter_audit": filter_audit.query,
    "op13_window_dedup": window_dedup.query,
    "pipeline": pipeline.run,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op3_secrets": secrets.ORACLE,
    "op4_sharding": sharding.ORACLE,
    "op10_suffix_dedup": suffix_dedup.ORACLE,
    "op11_importance": importance.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_window_dedup": window_dedup.ORACLE,
}
