"""Registered queries of this subpackage: ``opN_<name>`` over whole tables, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rankflow.llm import alignment, bilinear, chat, kdtree, langid, licenses, mih, mixing, packing, pii, simhash, spelling, substrings
from rankflow.llm.common import table


def _over(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _over("documents", langid.query),
    "op2_source_mix": _over("documents", mixing.query),
    "op3_repeated_bytes": _over("documents", substrings.query),
    "op4_nearest_codes": _over("embeddings", mih.query),
    "op5_retrieval_packing": _over("documents", packing.query),
    "op6_exact_products": _over("embeddings", kdtree.query),
    "op7_chat_trees": _over("conversations", chat.query),
    "op8_license_notices": _over("documents", licenses.query),
    "op9_simhash_components": _over("documents", simhash.query),
    "op10_personal_data": _over("documents", pii.query),
    "op11_spelling_variants": _over("documents", spelling.query),
    "op12_token_alignment": _over("documents", alignment.query),
    "op13_bilinear_scores": _over("documents", bilinear.query),
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {"op7_chat_trees": chat.ORACLE, "op11_spelling_variants": spelling.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle() -> dict[str, str]:
    return dict(ORACLE)
