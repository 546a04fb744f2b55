"""Token-count totals kept up to date by signed deltas, with idempotent batch commits.

A change is one row (batch, op, source, lang, version, tokens, was): an insert adds
a document and its tokens, a delete takes them away, a revision replaces `was`
with `tokens`. A commit sums a batch's changes per (source, lang, version) before
anything is stored, writes that small table to a staging folder and renames it to the
batch's own name; a name that is committed is never written again, so a replay changes
nothing. Totals are the sum of the committed tables; compact() folds the named batches
into a base and remembers their names, so late replays change nothing either.

A lost executor or a failed commit leaves the batch absent or whole. A batch has one
writer at a time; two that commit one name at once need a store with atomic renames.

Defined results: null source and lang are groups of their own; null tokens count
0; an unknown or null op counts nothing; repeated rows of one batch are counted
as often as they stand; an empty batch commits and adds nothing; other columns
are ignored.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm._shared import scratch
from callweave.llm.tokens import token_ids

KEYS = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs bigint, tokens bigint"
#: Vocabularies that counts are kept for, each a tokenizer version.
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def signed(changes: DataFrame) -> DataFrame:
    """changes with docs and tokens as signed amounts."""
    op, n, was = F.col("op"), F.coalesce("tokens", F.lit(0)), F.coalesce("was", F.lit(0))
    docs = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0).cast("bigint")
    tokens = F.when(op == "insert", n).when(op == "delete", -n).when(op == "revise", n - was).otherwise(0).cast("bigint")
    return changes.select(*KEYS, docs.alias("docs"), tokens.alias("tokens"))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """The totals under one folder: base/, folded.txt's batch names and one folder for each later batch."""

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or f"{scratch(spark)}/rollup"
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _names(self, kind: str) -> list[str]:
        at = self._at(kind)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _base(self) -> str | None:
        """The newest base that was finished."""
        done = [x for x in self._names("base") if self._fs.exists(self._at("base", x, "sums", "_SUCCESS"))]
        return done[-1] if done else None

    def _folded(self) -> set[str]:
        base = self._base()
        return {r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.path}/base/{base}/batches").collect()} if base else set()

    def pending(self) -> list[str]:
        """Batches that are committed and not folded into the base."""
        done = [x for x in self._names("batch") if self._fs.exists(self._at("batch", x, "_SUCCESS"))]
        return sorted(set(done) - self._folded())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch's summed deltas; False, and no work, if the batch is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch names take letters, digits, _ . and -: {batch!r}")
        if batch in self._folded() or batch in self.pending():
            return False
        staged = f"staged/{batch}-{uuid.uuid4().hex}"
        _sums(signed(changes)).write.parquet(f"{self.path}/{staged}")
        if batch in self._folded() or batch in self.pending():
            # the same batch was committed meanwhile: it holds the same rows
            self._fs.delete(self._at(staged), True)
            return False
        self._fs.delete(self._at("batch", batch), True)  # what an unfinished commit left, never a committed batch
        self._fs.mkdirs(self._at("batch"))
        if not self._fs.rename(self._at(staged), self._at("batch", batch)):
            raise OSError(f"batch {batch!r} could not be put in place")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens); groups that came down to nothing are left out."""
        base = self._base()
        paths = [f"{self.path}/batch/{x}" for x in self.pending()] + ([f"{self.path}/base/{base}/sums"] if base else [])
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return _sums(rows).where((F.col("docs") != 0) | (F.col("tokens") != 0))

    def compact(self) -> None:
        """Fold the pending batches into a new base. The base counts once its sums are whole; names are written first."""
        folded, base = sorted(self._folded() | set(self.pending())), self._base()
        new = f"{int(base or 0) + 1:012d}"
        self.spark.createDataFrame([(x,) for x in folded], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base/{new}/batches")
        self.totals().write.mode("overwrite").parquet(f"{self.path}/base/{new}/sums")


def token_counts(docs: DataFrame, versions: tuple[str, ...] = VERSIONS) -> DataFrame:
    """(source, lang, version, tokens, guess) of docs (text, source, lang), a row for each document and version.

    guess is a cheap first count: a quarter of the UTF-8 bytes."""

    def count(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            for version in versions:
                n = pa.array([len(token_ids(t, version)) for t in texts], pa.int64())
                guess = pa.array([len((t or "").encode("utf-8", "surrogatepass")) // 4 for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("source"), batch.column("lang"), pa.array([version] * len(texts)), n, guess], ["source", "lang", "version", "tokens", "guess"])

    chosen = docs.select(F.col("source").cast("string"), F.col("lang").cast("string"), "text")
    return chosen.mapInArrow(count, "source string, lang string, version string, tokens bigint, guess bigint")
