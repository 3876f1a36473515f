"""Operators for training-data pipelines (deduplication, archives, quality,
tokenising, packing). Nothing outside this subpackage imports it, except the
guarded import in ``__spark_entry__.py`` and ``corpus_pipeline.py``."""
