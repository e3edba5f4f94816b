"""The registered queries of the operators, and the SQL of those SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barsight.llm.alignment import op12_alignment
from barsight.llm.fingerprints import op3_fingerprints
from barsight.llm.licenses import op6_licenses
from barsight.llm.mixing import op7_mixing
from barsight.llm.mtree import ORACLE as TOP_PRODUCTS_SQL
from barsight.llm.mtree import op9_top_products
from barsight.llm.near_dedup import op5_near_dedup
from barsight.llm.order_join import op13_ngram_join
from barsight.llm.passages import op8_passages
from barsight.llm.pieces import op10_pieces
from barsight.llm.quality import op1_quality
from barsight.llm.runs import op11_periodic_runs
from barsight.llm.sharding import op2_sharding
from barsight.llm.toxicity import op4_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_sharding": op2_sharding,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_near_dedup": op5_near_dedup,
    "op6_licenses": op6_licenses,
    "op7_mixing": op7_mixing,
    "op8_passages": op8_passages,
    "op9_top_products": op9_top_products,
    "op10_pieces": op10_pieces,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_alignment": op12_alignment,
    "op13_ngram_join": op13_ngram_join,
}

ORACLE: dict[str, str] = {"op9_top_products": TOP_PRODUCTS_SQL}
