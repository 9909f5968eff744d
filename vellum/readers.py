"""The seam to external readers: a batch goes in, a struct of text, failed and error comes out.

A reader that raises fails its row, not the task; SealError alone stops the run, as it tells of a reader outside a
sealed machine.  Readers are made once per worker.

Cases: a null request is read as empty; a null answer is the empty text.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class SealError(RuntimeError):
    pass


class Reader(Protocol):
    def read(self, request: str, prompt: str) -> str: ...


@dataclass
class Told:
    """A reader that answers from a table, for tests and replays."""

    answers: dict[str, str]

    def read(self, request: str, prompt: str) -> str:
        return self.answers[request]


def backoff(attempt: int) -> float:
    """Seconds to wait before another attempt: doubling from one half, eight at most."""
    return min(0.5 * 2**attempt, 8.0)


def patient(read: Callable[[], str], retries: int, wait: Callable[[float], None] = time.sleep) -> str:
    """The answer of the first attempt that does not fail; a seal is never tried again."""
    for attempt in range(retries + 1):
        try:
            return read()
        except SealError:
            raise
        except Exception:
            if attempt == retries:
                raise
            wait(backoff(attempt))
    raise AssertionError


def ready(reader: Reader, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> bool:
    """Whether a reader answers at all, asked before a batch."""
    try:
        patient(lambda: reader.read("", "ready?"), tries - 1, wait)
    except SealError:
        raise
    except Exception:
        return False
    return True


ANSWER = "text string, failed boolean, error string"


def reading(request: Column, make: Callable[[], Reader], prompt: str = "transcribe", retries: int = 0) -> Column:
    """struct<text, failed, error> for each request."""
    made: list[Reader] = []

    @F.pandas_udf(ANSWER)
    def ask(requests: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(make())
        rows = []
        for r in requests:
            try:
                rows.append((patient(lambda r=r: made[0].read(r or "", prompt), retries) or "", False, None))
            except SealError:
                raise
            except Exception as e:
                rows.append(("", True, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["text", "failed", "error"])

    return ask(request)


#: Readers by name: how to make one, and whether it can run here.
_known: dict[str, tuple[Callable[[], Reader], Callable[[], bool]]] = {}


def register(name: str, make: Callable[[], Reader], available: Callable[[], bool] = lambda: True) -> None:
    _known[name] = (make, available)


def available() -> list[str]:
    return sorted(n for n, (_, can) in _known.items() if can())


def named(name: str) -> Callable[[], Reader]:
    return _known[name][0]
