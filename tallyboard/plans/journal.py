"""Journal of a named run, so that one that broke goes on where it stopped."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Iterable, Mapping

from ..functions.scalars import as_date
from ..operators.periods import Span
from ..sources import folders
from ..sources.store import Store

LATE = "late@"


def state_of(ledgers: Mapping[str, Mapping[dt.date, int]], end: dt.date) -> str:
    """Digest of the roll-ups as reports up to ``end`` see them: their days and the events of each."""
    lines = [f"{table} {d} {n}" for table in sorted(ledgers) for d, n in sorted(ledgers[table].items()) if d <= end]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


class Journal:
    """Finished steps of one run, each an empty file in a folder of the run: it is there whole or not at all.

    A step counts as finished for the state of the roll-ups it was computed from; rows that came late since
    make it open again. The journal holds one name per step and is read by one listing.
    """

    def __init__(self, store: Store, run: str):
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
            raise ValueError(f"letters, digits, dots, dashes and underscores name a run, not {run!r}")
        self.spark, self.path = store.spark, f"{store.path('_journal')}/{run}"
        self._names = set(folders.names(self.spark, self.path))

    def _add(self, name: str) -> None:
        if name not in self._names:
            folders.mark(self.spark, f"{self.path}/{name}")
            self._names.add(name)

    @staticmethod
    def _step(task: str, span: Span, state: str) -> str:
        return f"{task}@{span.start.isoformat()}~{span.end.isoformat()}@{state}"

    def finished(self, task: str, span: Span, state: str) -> bool:
        return self._step(task, span, state) in self._names

    def finish(self, task: str, span: Span, state: str) -> None:
        self._add(self._step(task, span, state))

    def note_late(self, days: Iterable[dt.date]) -> None:
        """Days that this run rolls up again; noted before the ledger forgets that they were late."""
        for d in days:
            self._add(LATE + d.isoformat())

    def late(self) -> list[dt.date]:
        return sorted(as_date(n.removeprefix(LATE)) for n in self._names if n.startswith(LATE))

    def once(self, step: str) -> bool:
        """True until ``done`` was called for a step that has no date."""
        return f"{step}@" not in self._names

    def done(self, step: str) -> None:
        self._add(f"{step}@")
