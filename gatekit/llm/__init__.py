"""Operators of a training-data pipeline: quality rules, licence scans, near and
substring de-duplication, sharding, packing, toxicity, byte-level BPE, WARC.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
