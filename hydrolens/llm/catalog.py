"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from hydrolens.llm import (
    decontamination, katz, language_id, lexical_search, licenses, manifest, mixing, near_duplicates, nearest, sharding,
    substring_dedup, token_files, url_rules,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_positional_index": decontamination.contaminated_documents,
        "op2_katz_backoff": katz.document_scores,
        "op3_budget_tree": mixing.document_mixture,
        "op4_difference_cover": substring_dedup.document_passages,
        "op5_nearest_centroid": language_id.document_languages,
        "op6_bayes_minhash": near_duplicates.document_groups,
        "op7_projected_neighbours": nearest.embedding_neighbours,
        "op8_license_bands": licenses.document_licenses,
        "op9_jump_shards": sharding.document_shards,
        "op10_token_files": token_files.document_tokens,
        "op11_merkle_manifest": manifest.document_proofs,
        "op12_url_rules": url_rules.page_verdicts,
        "op13_bag_search": lexical_search.benchmark_documents,
        "pipeline": corpus_pipeline.run,
    }


def statements() -> dict[str, str]:
    return {
        "op1_positional_index": decontamination.CONTAMINATED_SQL,
        "op3_budget_tree": mixing.MIXTURE_SQL,
        "op4_difference_cover": substring_dedup.PASSAGES_SQL,
        "op8_license_bands": licenses.LICENSES_SQL,
        "op11_merkle_manifest": manifest.PROOFS_SQL,
        "op12_url_rules": url_rules.VERDICTS_SQL,
        "op13_bag_search": lexical_search.SEARCH_SQL,
    } | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
