"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from landfall.llm.ann import op7_nearest_neighbours
from landfall.llm.byte_bpe import op8_byte_bpe
from landfall.llm.common import ship_package
from landfall.llm.conversation_repair import op12_conversation_repair
from landfall.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from landfall.llm.filter_audit import OP13_SQL, op13_filter_audit
from landfall.llm.html_extract import op6_html_extraction
from landfall.llm.mixing import op9_mixing
from landfall.llm.quality_fm import op4_quality_classifier
from landfall.llm.sharding import op10_sharding
from landfall.llm.simhash_dedup import op5_simhash_near_dedup
from landfall.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from landfall.llm.suffix_dedup import op11_suffix_dedup
from landfall.llm.token_counts import op3_token_counts


def _shipped(fn):
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


LLM_QUERIES = {fn.__name__: _shipped(fn) for fn in (
    op1_substring_dedup, op2_exact_dedup, op3_token_counts, op4_quality_classifier, op5_simhash_near_dedup,
    op6_html_extraction, op7_nearest_neighbours, op8_byte_bpe, op9_mixing, op10_sharding, op11_suffix_dedup, op12_conversation_repair,
    op13_filter_audit)}

LLM_SQL = {"op1_substring_dedup": OP1_SQL, "op2_exact_dedup": OP2_SQL, "op13_filter_audit": OP13_SQL}
