"""A registry of predicates by rule id, for user code that decides at run time."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Evaluator = Callable[[dict], bool]


class Registry:
    """Evaluators by rule id; the last one registered counts."""

    def __init__(self) -> None:
        self._of: dict[str, Evaluator] = {}

    def register(self, rule_id: str | None, evaluator: Evaluator | None) -> None:
        """Set an id's evaluator; a null id or evaluator is ignored."""
        if rule_id is not None and evaluator is not None:
            self._of[rule_id] = evaluator

    def reset(self) -> None:
        self._of.clear()

    def if_match(self, rule_id: str | None, row: dict | None = None) -> bool:
        """What the id's evaluator says of a row; true without one, or if it fails."""
        evaluator = self._of.get(rule_id) if rule_id is not None else None
        if evaluator is None:
            return True
        try:
            return bool(evaluator(row or {}))
        except Exception:  # fail-open is the contract: a broken predicate must not hide what it guards
            return True

    def matched(self, df: DataFrame, rule_id: str, inputs: list[str]) -> Column:
        """A column that is if_match() of each row's id over its input columns; batches cross as Arrow."""
        frozen = Registry()
        frozen._of = dict(self._of)

        @F.pandas_udf("boolean")
        def run(key: pd.Series, values: pd.DataFrame) -> pd.Series:
            rows = values.to_dict("records")
            return pd.Series([frozen.if_match(k, r) for k, r in zip(key, rows, strict=True)], dtype="boolean")

        return run(df[rule_id], F.struct(*(df[c] for c in inputs)))
