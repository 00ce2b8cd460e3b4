"""Results of page queries kept for some minutes, by plan."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from gaugelake.plans.views import fetch

#: How long a result is shown, in seconds.
LIFETIME = 300.0


@dataclass
class _Entry:
    plan: DataFrame
    until: float
    page: pd.DataFrame | None = None
    frame: DataFrame | None = None


class ResultCache:
    """Pages and frames by the meaning of their plan.

    Two frames with the same plan share an entry, whoever built them: entries are found by
    ``semanticHash`` and confirmed by ``sameSemantics``. A page (``fetch``) is kept as the local rows it
    consists of, so showing it again runs no job. A frame (``frame``) that several pages build on is
    persisted on the executors. Both are given up when their time is over, frames by ``unpersist``;
    the next call then reads the files as they are.

    ``most`` bounds a page's rows (more are an error, never cut), ``entries`` the number of
    entries; the oldest makes room.
    """

    def __init__(
        self,
        lifetime: float = LIFETIME,
        most: int = 100_000,
        entries: int = 200,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.lifetime, self.most, self.entries, self.clock = lifetime, most, entries, clock
        self._held: dict[int, list[_Entry]] = {}

    def __len__(self) -> int:
        return sum(map(len, self._held.values()))

    def _release(self, keep: Callable[[_Entry], bool]) -> None:
        for key, held in list(self._held.items()):
            for entry in held:
                if not keep(entry) and entry.frame is not None:
                    entry.frame.unpersist()
            self._held[key] = [entry for entry in held if keep(entry)]
            if not self._held[key]:
                del self._held[key]

    def _entry(self, df: DataFrame) -> _Entry:
        now = self.clock()
        self._release(lambda entry: entry.until > now)
        # A persisted frame does not change the plan that frames are compared by.
        same = self._held.setdefault(df.semanticHash(), [])
        for entry in same:
            if entry.plan.sameSemantics(df):
                return entry
        same.append(entry := _Entry(df, now + self.lifetime))
        if len(self) > self.entries:
            oldest = min((e for held in self._held.values() for e in held if e is not entry), key=lambda e: e.until)
            self._release(lambda e: e is not oldest)
        return entry

    def fetch(self, df: DataFrame) -> pd.DataFrame:
        """The rows of a page; a copy, so that a page may change what it got."""
        entry = self._entry(df)
        if entry.page is None:
            entry.page = fetch(df, self.most)
        return entry.page.copy()

    def frame(self, df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
        """The frame, persisted until its time is over."""
        entry = self._entry(df)
        if entry.frame is None:
            # A frame of its own: what the caller holds is not persisted by the cache.
            entry.frame = df.select("*").persist(level)
        return entry.frame

    def clear(self) -> None:
        """Give up all entries."""
        self._release(lambda entry: False)
