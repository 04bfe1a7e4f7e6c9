"""Operators of a training-data pipeline (de-duplication, decontamination,
PII and secret scans, language and quality models, packing, WARC, HTML).

Nothing else in the library imports this subpackage.
"""
