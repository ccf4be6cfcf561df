"""Operators of a training-data pipeline. Nothing outside this package and corpus_pipeline.py imports it."""

from bitextloom.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
