"""Operators for preparing text corpora: language ID, deduplication, secret scans,
decontamination, tokenisation, sharding, language-model scoring and quality filtering."""
