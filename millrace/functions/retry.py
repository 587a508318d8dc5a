"""Retries of metadata writes: attempts with exponential, jittered pauses."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import Column
from pyspark.sql import functions as F

R = TypeVar("R")
#: Status codes of which another attempt may succeed.
RETRYABLE = ("Unavailable", "DeadlineExceeded", "ResourceExhausted", "Internal")


class StatusError(Exception):
    """A failed call with the status code that it gave."""

    def __init__(self, code: str, message: str = ""):
        super().__init__(message or code)
        self.code = code


@dataclass
class RetryPolicy:
    """Defaults are fixed values: 5 attempts, 0.1 s doubling up to 5 s, 20 % jitter. Odd settings are brought into range when used."""

    max_attempts: int = 5
    min_backoff: float = 0.1
    max_backoff: float = 5.0
    multiplier: float = 2.0
    jitter: float = 0.2
    rng: random.Random = field(default_factory=random.Random)

    def backoff(self, attempt: int) -> float:
        """Seconds to wait after the attempt with this number (from 1)."""
        low = max(self.min_backoff, 0.0)
        base = min(low * max(self.multiplier, 1.0) ** (attempt - 1), max(self.max_backoff, low))
        spread = min(max(self.jitter, 0.0), 1.0)
        return base * (1 + spread * (2 * self.rng.random() - 1)) if spread else base

    def attempts(self, sleep: Callable[[float], bool | None] = time.sleep) -> Iterator[int]:
        """Numbers of attempts, with pauses before all but the first. ``sleep`` returns True if it was cancelled, which ends them."""
        for n in range(1, max(self.max_attempts, 1) + 1):
            if n > 1 and sleep(self.backoff(n - 1)):
                return
            yield n


#: What errors of Spark and of file systems say, and the status code that it stands for.
_SAID = (
    ("java.util.concurrent.TimeoutException", "DeadlineExceeded"), ("java.net.SocketTimeoutException", "DeadlineExceeded"), ("java.io.IOException", "Unavailable"), ("java.net.", "Unavailable"),
    ("org.apache.hadoop.ipc.RemoteException", "Unavailable"), ("java.io.UncheckedIOException", "Unavailable"),
)


def status_of(error: BaseException | None) -> str:
    """The status code of an error: its own, or that of what a write through Spark or a file system failed with."""
    if error is None:
        return "OK"
    if isinstance(error, StatusError):
        return error.code
    if isinstance(error, TimeoutError):
        return "DeadlineExceeded"
    if isinstance(error, (FileNotFoundError, PermissionError, FileExistsError)):
        return {FileNotFoundError: "NotFound", PermissionError: "PermissionDenied"}.get(type(error), "AlreadyExists")
    if isinstance(error, OSError):
        return "Unavailable"
    if type(error).__module__.split(".")[0] in ("pyspark", "py4j"):
        text = str(error)
        return next((code for name, code in _SAID if name in text), "InvalidArgument")
    return "Unknown"


def retryable(error: BaseException | None) -> bool:
    return status_of(error) in RETRYABLE


def retried(call: Callable[[], R], policy: RetryPolicy, sleep: Callable[[float], bool | None] = time.sleep) -> R:
    """The call's result; errors that don't pass by themselves are raised at once, others after the last attempt."""
    last: BaseException | None = None
    for _ in policy.attempts(sleep):
        try:
            return call()
        except Exception as e:
            last = e
            if not retryable(e):
                break
    raise last if last is not None else RuntimeError("no attempt was made")


def backoff_ms(attempt: Column, minimum: float, maximum: float, multiplier: float, jitter: float = 0.0, u: Column | None = None) -> Column:
    """The same pause in milliseconds as a column; ``u`` is uniform in [0, 1)."""
    low = F.greatest(F.lit(float(minimum)), F.lit(0.0))
    base = F.least(low * F.pow(F.greatest(F.lit(float(multiplier)), F.lit(1.0)), attempt - 1), F.greatest(F.lit(float(maximum)), low))
    spread = F.least(F.greatest(F.lit(float(jitter)), F.lit(0.0)), F.lit(1.0))
    return base * (1 + spread * (2 * (u if u is not None else F.rand()) - 1)) if jitter else base
