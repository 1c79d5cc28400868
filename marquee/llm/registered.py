"""Imports every module that registers a query."""

from marquee.llm import (  # noqa: F401
    op1_dual_tree,
    op2_mixing,
    op3_ngram_join,
    op4_line_spread,
    op5_chat_format,
    op6_cotraining,
    op7_histogram_shards,
    op8_url_words,
    op9_decontaminate,
    op10_secret_scan,
    op11_byte_bpe,
    op12_resampling,
    op13_whitening,
)
from marquee.llm.plans import ORACLES, QUERIES  # noqa: F401
