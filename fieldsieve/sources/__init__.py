"""Readers for crawl dumps, JSON lines, listings, text corpora and token shards."""
