"""The registered queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raw2clean.llm.op01_toxicity import op1_toxicity
from raw2clean.llm.op02_token_counts import op2_token_counts
from raw2clean.llm.op03_byte_bpe import op3_byte_bpe
from raw2clean.llm.op04_topk import OP4_SQL, op4_topk
from raw2clean.llm.op05_quality import op5_quality
from raw2clean.llm.op06_mixing import op6_mixing
from raw2clean.llm.op07_line_dedup import OP7_SQL, op7_line_dedup
from raw2clean.llm.op08_fingerprints import op8_fingerprints
from raw2clean.llm.op09_url_filter import OP9_SQL, op9_url_filter
from raw2clean.llm.op10_ngram_jaccard import OP10_SQL, op10_ngram_jaccard
from raw2clean.llm.op11_ranked_search import OP11_SQL, op11_ranked_search
from raw2clean.llm.op12_simhash import op12_simhash
from raw2clean.llm.op13_runs import op13_periodic_runs

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_topk": op4_topk,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_url_filter": op9_url_filter,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_ranked_search": op11_ranked_search,
    "op12_simhash": op12_simhash,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {"op4_topk": OP4_SQL, "op7_line_dedup": OP7_SQL, "op9_url_filter": OP9_SQL,
                              "op10_ngram_jaccard": OP10_SQL, "op11_ranked_search": OP11_SQL}
