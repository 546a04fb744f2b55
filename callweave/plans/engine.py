"""Whole runs: sources to events to rules to files.

Kotlin events are found by DataFrame operations over lines; the other scanners run once
per file on the executors and give rows; everything after them is DataFrame operations. A file that a scanner cannot read gives no rows and shows in
failures().
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callweave.operators import dispatch, rules
from callweave.operators import events as ev
from callweave.plans import diagnostics, sink
from callweave.plans.config import Config
from callweave.sources import files, java, kotlin_lines, kotlin_tree
from callweave.streaming import sink as stream_sink

EVENT_FIELDS = "language fqcn method signature kind line condition_text".split()
ROW_FIELDS = "language fqcn method rule_kind line condition_text".split()


def _scan_files(sources: DataFrame, fields: list[str], scan: Callable[[str, str, str], Iterator[tuple]]) -> DataFrame:
    """Rows of scan(language, text, file name) with path, idx and error; a file that fails gives one row that says why."""
    types = {"line": pa.int32()}

    def run(batches):
        for batch in batches:
            rows = []
            for language, path, text in zip(*(batch.column(c).to_pylist() for c in ("language", "path", "text")), strict=True):
                try:
                    found = list(scan(language, text, PurePosixPath(path).name))
                    rows += [(*row, path, k, None) for k, row in enumerate(found)]
                except Exception as e:  # one unreadable file must not end the run; it is reported
                    rows.append((*[None] * len(fields), path, 0, f"{type(e).__name__}: {e}"))
            columns = [pa.array([r[k] for r in rows], types.get(name, pa.string())) for k, name in enumerate(fields)]
            tail = [pa.array([r[k] for r in rows], t) for k, t in ((-3, pa.string()), (-2, pa.int64()), (-1, pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *tail], [*fields, "path", "idx", "error"])

    schema = ", ".join(f"{f} {'int' if f == 'line' else 'string'}" for f in fields) + ", path string, idx long, error string"
    return sources.select("language", "path", "text").mapInArrow(run, schema)


def kotlin_events(sources: DataFrame, keys: list[str], include: list[str] = ()) -> DataFrame:
    """Events of Kotlin files in the form of _scan_files(); there is no file that this cannot read."""
    found = kotlin_lines.events(sources, keys, include)
    return found.select(*EVENT_FIELDS, "path", "idx", F.lit(None).cast("string").alias("error"))


class Engine:
    """One configuration bound to a session.

    Scanned rows are kept, on executors' disks where memory is short, because conditions, methods and rules are
    all read from them; a lost executor's part is scanned again. close(), or leaving a with block, drops them."""

    def __init__(self, spark: SparkSession, config: Config = Config()) -> None:
        self.spark, self.config = spark, config
        self.log = diagnostics.logger(config.log_level, config.log_file)
        self._scanned: DataFrame | None = None

    def __enter__(self) -> "Engine":
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        if self._scanned is not None:
            self._scanned.unpersist()
            self._scanned = None

    def sources(self, language: str) -> DataFrame:
        c = self.config
        roots = [files.resolve_path(d, c.project_dir) for d in c.src_dirs]
        return files.read_sources(self.spark, roots, language, list(c.include_patterns), list(c.exclude_patterns), c.max_file_bytes)

    def _pruned(self, language: str) -> DataFrame:
        """Sources in a chosen package; the package is found by a column expression, so other files are never scanned."""
        found = self.sources(language).withColumn("package", files.package_of(F.col("text"), language))
        return ev.by_package(found, self.config.prefixes)

    def scanned(self) -> DataFrame:
        """Events and failures of all files."""
        if self._scanned is not None:
            return self._scanned
        frames = [kotlin_events(self._pruned("kotlin"), ["root", "path"])]
        if self.config.include_java:
            scan = java.scan
            frames.append(_scan_files(self._pruned("java"), EVENT_FIELDS, lambda _, text, name: scan(text, name)))
        self._scanned = ev.union_all(*frames).persist(StorageLevel.MEMORY_AND_DISK)
        return self._scanned

    def failures(self) -> DataFrame:
        return self.scanned().where("error is not null").select("path", "error")

    def events(self) -> DataFrame:
        """All events; scan_seq orders those of one file, whose class and method tell files apart."""
        found = self.scanned().where("error is null and fqcn is not null")
        seq = F.struct(F.when(F.col("language") == "kotlin", 0).otherwise(1).alias("rank"), "path", "idx")
        return found.select(*EVENT_FIELDS, seq.alias("scan_seq"))

    def rules(self) -> DataFrame:
        """The rules of a run before selection."""
        return self._event_rules() if self.config.use_ast_scanner else self._legacy_rules()

    def _event_rules(self) -> DataFrame:
        c = self.config
        events = ev.usable(self.events(), c.prefixes).withColumn("scan_seq", F.concat_ws(":", F.col("scan_seq.rank"), F.col("scan_seq.path"), F.format_string("%012d", F.col("scan_seq.idx"))))
        out = rules.to_rules(events, c.style)
        if not c.include_java:
            return out
        # without enter and exit rules no method counts as seen, as in compatible runs; strict looks at the events
        seen = events.where(F.col("language") == "java") if c.entry_exit or c.strict else events.limit(0)
        fallback = self._regex_rows(java.declared_methods, c.package_prefix, seen)
        return ev.union_all(out, rules.from_rows(fallback, c.style, 1))

    def _regex_rows(self, declared: Callable, prefix: str, seen: DataFrame | None) -> DataFrame:
        """Regex rule rows of Java files, only those of declared methods without an event if `seen` is given."""
        entry_exit = self.config.entry_exit

        def scan(_, text, __):
            wanted = declared(text) if declared else None
            for fqcn, method, *rest in java.regex_rules(text, prefix, entry_exit):
                if wanted is None or (fqcn, method) in wanted:
                    yield "java", fqcn, method, *rest

        rows = _scan_files(self.sources("java"), ROW_FIELDS, scan).where("error is null and fqcn is not null").drop("error")
        return rows if seen is None else rows.join(seen.select("fqcn", "method").distinct(), ["fqcn", "method"], "left_anti")

    def _legacy_rules(self) -> DataFrame:
        c = self.config
        prefix, tracked, entry_exit = c.package_prefix.strip() or None, set(c.tracked_vars), c.entry_exit

        def scan(_, text, name):
            for row in kotlin_tree.legacy_rules(text, name, prefix, tracked, entry_exit):
                yield "kotlin", *row

        rows = _scan_files(self.sources("kotlin"), ROW_FIELDS, scan).where("error is null and fqcn is not null").drop("error")
        out = rules.from_rows(rows, c.style, 0)
        return ev.union_all(out, rules.from_rows(self._regex_rows(None, c.package_prefix, None), c.style, 1)) if c.include_java else out

    def header(self) -> str:
        c = self.config
        stamp = datetime.now(timezone.utc).isoformat().replace("+00:00", "Z") if c.include_timestamp else None
        return rules.header(c.generator, c.helper, c.prefixes, list(c.tracked_vars), stamp, spaced=c.use_ast_scanner)

    def files(self) -> DataFrame:
        """(file, seq, value): the lines of all output files."""
        c = self.config
        kept = dispatch.selected(self.rules(), c.prefixes, c.min_branches_per_method, c.strict)
        head = self.header()
        turned = dispatch.rotated(dispatch.sharded(kept, c.shard_count), len(head.encode()), c.rotate_max_bytes_per_file, c.shard_count)
        return dispatch.file_lines(turned, head, c.prefix, c.shard_count, c.rotate_max_bytes_per_file > 0, c.gzip_output)

    def write(self, path: str) -> list[str]:
        """Write the files below path and return their names; files that no scanner could read are reported."""
        self.log.info("writing %d shards below %s", self.config.shard_count, path)
        names = sink.write_files(self.files(), path, self.config.gzip_output)
        if self.config.use_ast_scanner and self.log.isEnabledFor(logging.WARNING):
            for row in self.failures().orderBy("path").toLocalIterator():
                self.log.warning("%s: %s", row["path"], row["error"])
        self.log.info("wrote %d files", len(names))
        return names

    def write_stream(self, rules_stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
        """Write rules (shard_key, rule_text, and `at` if it orders those that come together) as they come.

        Size and interval of the configuration begin new files; without an interval what is there is taken once."""
        c = self.config
        interval = f"{c.rotate_interval_seconds} seconds" if c.rotate_interval_seconds > 0 else None
        limits = {"max_bytes": c.rotate_max_bytes_per_file, "interval_ms": 1000 * max(0, c.rotate_interval_seconds)}
        return stream_sink.start(rules_stream, path, checkpoint, self.header(), c.shard_count, interval, **limits, prefix=c.prefix, gzip=c.gzip_output)
