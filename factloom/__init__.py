"""Factloom: filing facts, contexts, units and narrative text as Spark DataFrames."""

__version__ = "0.1.0"
