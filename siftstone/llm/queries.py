"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftstone.llm import url_filters
from siftstone.llm.decontamination import op5_decontamination
from siftstone.llm.embedding_graph import op7_embedding_graph
from siftstone.llm.html_extraction import op4_html_extraction
from siftstone.llm.ngram_jaccard import op1_ngram_jaccard
from siftstone.llm.packing import op9_best_fit_packing
from siftstone.llm.pii import op10_pii
from siftstone.llm.quality_knn import op8_quality_knn
from siftstone.llm.sharding import op2_sharding
from siftstone.llm.suffix_dedup import op6_suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_sharding": op2_sharding,
    "op3_temporal_url_list": url_filters.op3_temporal_url_list,
    "op4_html_extraction": op4_html_extraction,
    "op5_decontamination": op5_decontamination,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_embedding_graph": op7_embedding_graph,
    "op8_quality_knn": op8_quality_knn,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_pii": op10_pii,
}

ORACLE_SQL: dict[str, str] = {"op3_temporal_url_list": url_filters.ORACLE}
