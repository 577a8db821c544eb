"""Operators of a training-data pipeline (search, deduplication, filters,
language and toxicity models, mixing).  Nothing else in the library
imports this subpackage; its queries are registered in ``queries.py``."""
