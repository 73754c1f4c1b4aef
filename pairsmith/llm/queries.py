"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairsmith.llm import license_scan, line_dedup
from pairsmith.llm.binary_records import op5_binary_records
from pairsmith.llm.conversation_repair import op12_conversation_repair
from pairsmith.llm.decontamination import op9_decontamination
from pairsmith.llm.fingerprints import op4_fingerprints
from pairsmith.llm.jaccard_join import op10_ngram_jaccard_join
from pairsmith.llm.language_id import op3_language_id
from pairsmith.llm.license_scan import op6_license_scan
from pairsmith.llm.line_dedup import op1_line_dedup
from pairsmith.llm.packing import op7_best_fit_packing
from pairsmith.llm.quality import op2_quality_classifier
from pairsmith.llm.spelling import op11_spelling_variants
from pairsmith.llm.substring_dedup import op8_substring_dedup
from pairsmith.llm.toxicity import op13_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_language_id": op3_language_id,
        "op4_fingerprints": op4_fingerprints,
        "op5_binary_records": op5_binary_records,
        "op6_license_scan": op6_license_scan,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_toxicity": op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.SQL, "op6_license_scan": license_scan.SQL}
