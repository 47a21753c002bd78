"""A registry of text scorers. Models can be registered under a name; the rule-based ones here are the defaults.

A scorer is a function from a text column to a column. Registered Python scorers work on Arrow
batches and load what they need once for each worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import text as X

Scorer = Callable[[Column], Column]
_SCORERS: dict[str, Scorer] = {}

# Frames of an article and their words.
FRAMES = {
    "S": "school|teacher|resident|family|학교|주민|schule|école|escuela|escola|школ",
    "T": "drone|software|robot|digital|드론|drohne|drones|дрон",
    "E": "budget|cost|fund|sale|tender|예산|haushalt|vente|venta|venda|бюджет",
    "En": "water|climate|flood|energy|식수|wasser|eau|agua|água|вод",
    "P": "council|court|ministry|law|법원|gericht|tribunal|conseil|суд",
}


def register(name: str, scorer: Scorer) -> None:
    _SCORERS[name] = scorer


def register_python(name: str, returns: str, load: Callable[[], Callable[[pd.Series], pd.Series]]) -> None:
    """A Python scorer: load() runs once for each partition and gives a function on a Series."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for b in batches:
            yield scorer(b)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}  # as objects: the names are strings here
    run = F.pandas_udf(run, returns)

    register(name, lambda c: run(c))


def score(name: str, text: Column) -> Column:
    return _SCORERS[name](text)


def _frame(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for k, pattern in FRAMES.items():
        out = F.when(low.rlike(pattern), k) if out is None else out.when(low.rlike(pattern), k)
    return out.otherwise("E")


register("sentiment", X.lexicon_score)
register("emotion", lambda c: F.transform(F.sequence(F.lit(1), F.lit(8)), lambda _: F.lit(0.125)))
register("steeps", _frame)
register("ner", lambda c: F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Z][a-z]{3,}"), F.lit(0))))
register("sbert", lambda c: F.transform(F.sequence(F.lit(1), F.lit(384)), lambda _: F.lit(0.0)))
register("nli", lambda c: F.lit(0.0))
