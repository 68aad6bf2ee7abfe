"""Named ways to bring in documents; what fetches over a network is registered by the user."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.sources.documents import find_documents

Source = Callable[..., DataFrame]
_SOURCES: dict[str, Source] = {}


def register_source(name: str, source: Source) -> None:
    """Add a source ``source(spark, ...) -> DataFrame``; a later one of the same name replaces it."""
    _SOURCES[name] = source


def get_source(name: str) -> Source:
    """The source of that name; an unknown one is an error that lists those there are."""
    if name not in _SOURCES:
        raise ValueError(f"unknown source {name!r}; there are {sorted(_SOURCES)}")
    return _SOURCES[name]


def _direct(spark: SparkSession, folder: str, **filters) -> DataFrame:
    return find_documents(spark, folder, **filters)


register_source("direct", _direct)
