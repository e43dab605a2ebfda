"""Registered queries of this subpackage and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalis.llm.bpe import op4_bpe
from vitalis.llm.embed import op9_embeddings
from vitalis.llm.jaccard import op8_jaccard
from vitalis.llm.langid import op5_language
from vitalis.llm.lexical import op12_lexical
from vitalis.llm.mixing import op2_mixing
from vitalis.llm.negatives import op11_negatives
from vitalis.llm.oracle import ORACLE
from vitalis.llm.quality import op6_quality
from vitalis.llm.sharding import op1_sharding
from vitalis.llm.substring import op3_substring
from vitalis.llm.topk import op13_topk
from vitalis.llm.warc import op7_warc
from vitalis.llm.wrappers import op10_html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_substring": op3_substring,
    "op4_bpe": op4_bpe,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_jaccard": op8_jaccard,
    "op9_embeddings": op9_embeddings,
    "op10_html": op10_html,
    "op11_negatives": op11_negatives,
    "op12_lexical": op12_lexical,
    "op13_topk": op13_topk,
}

__all__ = ["ORACLE", "QUERIES"]
