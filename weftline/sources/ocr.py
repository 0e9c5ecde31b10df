"""Engines that turn page images into text, by name.

An engine is a function of an image's bytes and a language.  None is part of this package: a caller
registers what its executors have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Engine = Callable[[bytes, str], str]
_ENGINES: dict[str, Callable[[], Engine]] = {}


def register(name: str, make: Callable[[], Engine]) -> None:
    """Make an engine known; ``make`` runs once a task, so an engine may hold what cannot be sent."""
    _ENGINES[name] = make


def engine(name: str) -> Callable[[], Engine]:
    """[A13] What makes the engine of a name; an unknown name is an error that lists the known ones."""
    if name not in _ENGINES:
        raise ValueError(f"unknown engine {name!r}; known are: {', '.join(sorted(_ENGINES)) or 'none'}")
    return _ENGINES[name]


def recognized(pages: DataFrame, key: str, image: str, name: str, lang: str) -> DataFrame:
    """[A13] (key, ocr_engine, raw_text) of page images by the engine of a name, in Arrow batches."""
    make = engine(name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = make()
        for pdf in batches:
            texts = [None if x is None else read(bytes(x), lang) for x in pdf["image"]]
            yield pd.DataFrame({key: pdf["key"], "ocr_engine": name, "raw_text": texts})

    kind = dict(pages.dtypes)[key]
    return pages.select(F.col(key).alias("key"), F.col(image).alias("image")).mapInPandas(run, f"{key} {kind}, ocr_engine string, raw_text string")
