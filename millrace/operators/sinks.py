"""Sinks for data changes: JSON lines to a stream or a folder."""

from __future__ import annotations

import sys
import threading
from typing import TextIO

from pyspark.sql import DataFrame, Row


class JsonLines:
    """A consumer that writes one line per record; lines are whole, whoever calls at the same time."""

    def __init__(self, out: TextIO = sys.stdout):
        self.out, self._lock = out, threading.Lock()

    def __call__(self, row: Row) -> None:
        with self._lock:
            self.out.write(row.record + "\n")
            self.out.flush()


def write_lines(lines: DataFrame, path: str) -> None:
    """A column of JSON text as files of lines, in parallel."""
    lines.write.mode("append").text(path)
