"""Operators of a training-data pipeline: deduplication, pseudonyms, archives, mixing, chat, quality, search and tokens."""
