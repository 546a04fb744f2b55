"""Size and time rotation of rules that come as a stream: keyed state by shard.

A shard's state is the file it writes to: its number, the bytes of its rules, how many
rules the shard has had, and when the file was begun. A file ends before a rule that
would overflow it, as in a batch, or before the first rule after its time is over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROTATED = "shard int, rotation int, seq long, rule_text string"
#: The store of keyed state that the processor needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rotate(sizes: np.ndarray, rotation: int, held: int, room: int) -> tuple[np.ndarray, int]:
    """Each rule's file, and the bytes that the last file then holds, for rules that follow `held` bytes in file `rotation`."""
    ends, files = np.cumsum(sizes), np.empty(len(sizes), np.int64)
    base, k = -held, 0
    while k < len(sizes):
        fit = max(k, int(np.searchsorted(ends, base + room, "right")))
        files[k:fit] = rotation
        if fit < len(sizes):  # one that is larger than a file has a file of its own
            rotation, base = rotation + 1, int(ends[fit] - sizes[fit])
            files[fit] = rotation
            fit += 1
        k = fit
    return files, int(ends[-1]) - base


class Rotation(StatefulProcessor):
    """Numbers the files of one shard; limits of 0 are off."""

    def __init__(self, header_bytes: int, max_bytes: int, interval_ms: int = 0, ordered: bool = False):
        self.header_bytes, self.max_bytes, self.interval_ms, self.ordered = header_bytes, max_bytes, interval_ms, ordered

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("file", "rotation int, held long, rules long, opened long, over boolean")

    def _begin(self, now: int) -> int:
        if self.interval_ms:
            self.handle.registerTimer(now + self.interval_ms)
        return now

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        rotation, held, rules, opened, over = self.state.get() if self.state.exists() else (1, 0, 0, self._begin(now), False)
        if self.ordered:  # a delivery's rules of one shard meet, so that they come in order
            rows = iter([pd.concat(list(rows)).sort_values("at", kind="stable")])
        for part in rows:
            if not len(part):
                continue
            if over or self.interval_ms and now - opened >= self.interval_ms:
                rotation, held, opened, over = rotation + 1, 0, self._begin(now), False
            sizes = part["bytes"].to_numpy(np.int64)
            if self.max_bytes > 0:
                before = rotation
                files, held = rotate(sizes, rotation, held, self.max_bytes - self.header_bytes)
                rotation = int(files[-1])
                if rotation > before:
                    opened = self._begin(now)
            else:
                files, held = np.full(len(part), rotation), held + int(sizes.sum())
            yield pd.DataFrame({"shard": key[0], "rotation": files, "seq": np.arange(rules, rules + len(part)), "rule_text": part["rule_text"].to_numpy()})
            rules += len(part)
        self.state.update((rotation, held, rules, opened, over))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rotation, held, rules, opened, _ = self.state.get()
        if held and timerValues.getCurrentProcessingTimeInMs() - opened >= self.interval_ms:  # timers of files that ended by size come too
            self.state.update((rotation, held, rules, opened, True))
        yield pd.DataFrame({c.split()[0]: [] for c in ROTATED.split(", ")})

    def close(self) -> None:
        pass


def rotated(rules: DataFrame, header_bytes: int, max_bytes: int, interval_ms: int = 0) -> DataFrame:
    """(shard, rotation, seq, rule_text) of a stream of rules (shard, rule_text, and `at` where it orders a delivery's rules)."""
    ordered = "at" in rules.columns
    sized = rules.select("shard", "rule_text", (F.coalesce(F.octet_length("rule_text"), F.lit(0)) + 2).cast("bigint").alias("bytes"), *(["at"] if ordered else []))
    processor = Rotation(header_bytes, max_bytes, interval_ms, ordered)
    # with timers a stream goes on for good, also one that takes what is there
    return sized.groupBy("shard").transformWithStateInPandas(processor, ROTATED, "Append", "ProcessingTime" if interval_ms > 0 else "None")
