"""Importing this module registers every query of the package."""

from docloom.llm import (  # noqa: F401
    cross_tokenizer, decontaminate, html_wrapper, jaccard_join, packing, quality_cascade, quality_classifier,
    secret_scan, sentence_spans, token_shards, toxicity, url_filter, whitening,
)
from docloom.llm.registry import ORACLE, QUERIES  # noqa: F401
