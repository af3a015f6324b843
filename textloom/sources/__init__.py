"""Corpus readers, dataset configurations, text sink and tokenizer tables."""
