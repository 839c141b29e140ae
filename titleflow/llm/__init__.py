"""Operators of a training-data pipeline: scoring, extraction, tokenising,
deduplication, decontamination and filtering of web-scale text.

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guarded
registration in ``__spark_entry__.py`` imports it.
"""
