"""Message scoring with a pluggable model: a callable over a list of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lexicon_scorer(words: dict[str, float]) -> Callable[[], Callable[[list[str]], list[float]]]:
    """A factory of scorers: the share of a text's words that the lexicon weighs, 0 to 1."""

    def load():
        def score(texts: list[str]) -> list[float]:
            out = []
            for text in texts:
                found = text.lower().split()
                out.append(min(1.0, sum(words.get(w.strip(".,!?"), 0.0) for w in found) / max(1, len(found))))
            return out

        return score

    return load


def scored(text: Column | str, factory: Callable[[], Callable[[list[str]], list[float]]]) -> Column:
    """Scores by an iterator UDF: the factory loads its model once a task, null texts score null."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = factory()
        for texts in batches:
            there = texts.notna()
            out = pd.Series([None] * len(texts), index=texts.index, dtype="float64")
            if there.any():
                out[there] = score(texts[there].tolist())
            yield out

    return run(text)
