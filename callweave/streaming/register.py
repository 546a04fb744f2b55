"""Registrations of evaluators as a stream, asked by another: keyed state of the latest one for each rule."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ANSWER = "rule_id string, asked long, matched boolean"


def match_stream(rules: DataFrame, registrations: DataFrame) -> DataFrame:
    """(rule_id, asked, matched) for a stream of rules (rule_id, asked), by a stream of (seq, rule_id, outcome).

    A rule's state is its registration of the highest seq so far, whatever order they come in; those that come together
    with a question are taken first. As in if_match(), outcomes are `true`, `false` or anything else, which stands for
    a failure; what fails, is not registered or has no id matches. Null ids and outcomes register nothing."""

    def answer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        seq, outcome = state.get if state.exists else (None, None)
        told = rows[rows["outcome"].notna()]
        if len(told) and key[0] is not None:
            last = told.iloc[[told["seq"].astype("int64").to_numpy().argmax()]]
            if seq is None or int(last["seq"].iloc[0]) >= seq:
                seq, outcome = int(last["seq"].iloc[0]), str(last["outcome"].iloc[0])
                state.update((seq, outcome))
        asked = rows[rows["asked"].notna()]
        yield pd.DataFrame({"rule_id": [key[0]] * len(asked), "asked": asked["asked"].astype("int64"), "matched": (outcome or "").lower() != "false"})

    none = lambda kind: F.lit(None).cast(kind)
    both = registrations.where("outcome is not null and seq is not null").select("rule_id", F.col("seq").cast("long").alias("seq"), "outcome", none("long").alias("asked"))
    both = both.union(rules.select("rule_id", none("long"), none("string"), F.col("asked").cast("long")))
    return both.groupBy("rule_id").applyInPandasWithState(answer, ANSWER, "seq long, outcome string", "append", GroupStateTimeout.NoTimeout)
