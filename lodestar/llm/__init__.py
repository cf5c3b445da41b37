"""Operators of a training-data pipeline: de-duplication, mixing, tokenizing,
chat formatting, search and toxicity.  Nothing outside this package imports
it; its queries are in ``lodestar.llm.queries``."""
