"""Operators that prepare training data: language, near copies, leaks, packing.

Nothing else in the library imports this package; it may be deleted together
with ``corpus_pipeline.py`` and ``tests/llm``.
"""
