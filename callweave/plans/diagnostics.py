"""Diagnostics of a run: a level threshold and a log file that can never fail the run."""

from __future__ import annotations

import logging
from pathlib import Path

#: Names of levels, from the most to the least said.
LEVELS = {"TRACE": 5, "DEBUG": logging.DEBUG, "INFO": logging.INFO, "WARN": logging.WARNING, "ERROR": logging.ERROR}


def level_of(name: str | None) -> int:
    """A level by its name in any case; anything else is ERROR."""
    return LEVELS.get((name or "").strip().upper(), logging.ERROR)


class _Quiet(logging.FileHandler):
    def handleError(self, record: logging.LogRecord) -> None:
        """A full or missing disk loses the line, not the run."""


def logger(level: str | None = "ERROR", path: str | None = None, name: str = "callweave") -> logging.Logger:
    """A logger at this threshold, mirrored to a file if one can be opened."""
    log = logging.getLogger(name)
    log.setLevel(level_of(level))
    for handler in list(log.handlers):
        log.removeHandler(handler)
        handler.close()
    if path:
        try:
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            handler = _Quiet(path, delay=False, encoding="utf-8")
        except OSError:
            return log
        handler.setFormatter(logging.Formatter("%(asctime)s.%(msecs)03d [%(levelname)s] %(message)s", "%Y-%m-%d %H:%M:%S"))
        log.addHandler(handler)
    return log
