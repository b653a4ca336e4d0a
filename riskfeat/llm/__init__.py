"""Operators for preparing training data: filtering, deduplication, mixing, tokens and language models."""
