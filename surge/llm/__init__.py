"""Operators for large-scale training-data pipelines (each module holds one).

Nothing outside this subpackage, ``corpus_pipeline`` and ``tests/llm`` imports it.
"""
