"""Operators for large-scale training-data pipelines (dedup, packing, scans,
quality, tokenising, language models, chat rendering, web archives).

Nothing outside this folder imports it; ``queries`` registers its queries.
"""
