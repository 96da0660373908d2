"""Corpus curation on Spark: filter, label, score, tokenize, sample and evaluate text tables."""
