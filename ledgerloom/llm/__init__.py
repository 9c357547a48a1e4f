"""Operators for training-data pipelines: packing, decontamination, deduplication, PII, WARC, scoring, chat."""
