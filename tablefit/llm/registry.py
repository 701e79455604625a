"""The queries of the subpackage, by name, and their SQL where it exists."""

from __future__ import annotations

from tablefit.llm import centroids, conversations, decontaminate, exact_dedup, grouping, jaccard_join, licenses, packing, quality, shard, suffix_dedup, token_counts, warc

QUERIES = {
    "op1_packing": packing.query,
    "op2_token_counts": token_counts.query,
    "op3_jaccard_join": jaccard_join.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_license_scan": licenses.query,
    "op5_license_files": licenses.query_files,
    "op6_warc": warc.query,
    "op7_shards": shard.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_decontamination": decontaminate.query,
    "op10_quality": quality.query,
    "op11_centroids": centroids.query,
    "op12_conversations": conversations.query,
    "op13_grouping": grouping.query,
}
ORACLE = {
    "op5_license_scan": licenses.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_centroids": centroids.ORACLE,
    "op12_conversations": conversations.ORACLE,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
