"""Queries of the training-data operators and of the corpus pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .brown import op12_lm_scoring
from .decontamination import op6_benchmark_decontamination
from .extraction import op7_html_extraction
from .fingerprints import op2_document_fingerprints
from .language import op4_language_id
from .neardup import op3_minhash_near_dedup
from .packing import op1_best_fit_packing
from .pii import op9_pii
from .repeats import op8_suffix_array_dedup
from .secrets import op10_secret_scans
from .survivorship import SQL as _GOLDEN
from .survivorship import op11_golden_record
from .toxicity import op5_toxicity
from .whitening import op13_embedding_whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = [op1_best_fit_packing, op2_document_fingerprints, op3_minhash_near_dedup, op4_language_id, op5_toxicity, op6_benchmark_decontamination, op7_html_extraction, op8_suffix_array_dedup, op9_pii, op10_secret_scans, op11_golden_record, op12_lm_scoring, op13_embedding_whitening, pipeline]
    return {f.__name__: f for f in out}


def oracle_sql() -> dict[str, str]:
    """The others need a tokenizer, a model, positions of overlapping matches, a transitive closure or eigenvectors (see tests/llm)."""
    return {"op11_golden_record": _GOLDEN}
