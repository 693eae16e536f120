"""Operators for training-data pipelines: dedup, decontamination, extraction, mixing, filtering, formatting.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
