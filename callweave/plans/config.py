"""Options of a run, with their defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from callweave.functions.predicates import EVALUATOR
from callweave.operators.events import merged_prefixes
from callweave.operators.rules import Style
from callweave.sources.files import MAX_FILE_BYTES


@dataclass(frozen=True)
class Config:
    """What a run reads, which rules it keeps and how it writes them.

    src_dirs, include_patterns, exclude_patterns and max_file_bytes choose files; include_java adds Java;
    pkg_prefixes and package_prefix choose packages and classes; min_branches_per_method chooses methods;
    tracked_vars choose writes in legacy mode; use_ast_scanner False is legacy mode; strict takes the corrected
    form of behaviour that is otherwise kept for compatibility. log_level and log_file say what a run reports and
    where; rotate_interval_seconds starts new files so often where rules come as a stream, 0 is off. A batch run
    writes all its files at one time, so there only their size rotates them."""

    src_dirs: tuple[str, ...] = ("src/main/java", "src/main/kotlin")
    project_dir: str = "."
    package_prefix: str = ""
    pkg_prefixes: tuple[str, ...] = ()
    helper: str = "trace.Helper"
    evaluator: str = EVALUATOR
    generator: str = "callweave"
    entry_exit: bool = True
    tracked_vars: tuple[str, ...] = ()
    include_java: bool = True
    include_timestamp: bool = False
    max_string_length: int = 0
    max_file_bytes: int = MAX_FILE_BYTES
    include_patterns: tuple[str, ...] = ()
    exclude_patterns: tuple[str, ...] = ()
    shards: int = field(default_factory=lambda: os.cpu_count() or 1)
    gzip_output: bool = False
    file_prefix: str = "tracing-"
    rotate_max_bytes_per_file: int = 4 << 20
    min_branches_per_method: int = 0
    safe_mode: bool = False
    force_helper_for_whitelist: bool = False
    use_ast_scanner: bool = True
    strict: bool = False
    log_level: str = "ERROR"
    log_file: str | None = None
    rotate_interval_seconds: int = 0

    @property
    def prefixes(self) -> list[str]:
        return merged_prefixes(list(self.pkg_prefixes), self.package_prefix)

    @property
    def style(self) -> Style:
        return Style(self.helper, self.entry_exit, self.max_string_length, self.safe_mode, self.force_helper_for_whitelist, self.evaluator, self.strict)

    @property
    def shard_count(self) -> int:
        return max(1, self.shards)

    @property
    def prefix(self) -> str:
        return self.file_prefix if self.file_prefix.strip() else "tracing-"
