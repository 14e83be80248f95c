"""Operators for building training data from text: each module holds one, ``queries`` registers them."""

from serieskit.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
