"""Gaps as keyed state: each run's evidence moves a gap on, timers say when it has rested and when it may be forgotten.

State is one value a gap.  Time is that of the runs: the watermark over
``run_at``, not the machine's clock, so a replay gives the same rows.  The session's
state store has to be RocksDB (``spark.sql.streaming.stateStore.providerClass``),
as ``session.local_session`` sets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paperloom.operators.gaps import COOLDOWN_DAYS, GAP, MOST_ATTEMPTS

#: What rows say: the gap is as given after a run; it has rested and may be followed up; it was closed so long ago that it is forgotten.
CHANGED, DUE, FORGOTTEN = "CHANGED", "DUE", "FORGOTTEN"
OUT = f"kind string, run_id string, {GAP}"
FIELDS = [c.split()[0] for c in GAP.split(", ")]


def moved_on(prior: dict | None, found: dict, run_id: str, at) -> dict | None:
    """A gap after a run's evidence; None if nothing changes."""
    did = [t for t in found["tries"] if t["status"] != "NOT_ATTEMPTED"]
    followed = [t for t in did if t["stage"] == "FOLLOWUP"]
    success = next((t["attempt_id"] for t in did if t["status"] in ("SUCCESS", "NO_RESULTS")), None) if found["may_resolve"] else None
    if not (found["is_gap"] or (prior and success is not None)):
        return None
    old = prior or {"first_seen_run": run_id, "last_attempt_run": run_id, "attempt_count": 0, "max_attempts": MOST_ATTEMPTS, "receipt_ids": [], "cooldown_until": None}
    count = old["attempt_count"] + len(followed)
    status = "RESOLVED" if success is not None else "UNRESOLVABLE" if found["is_gap"] and count >= old["max_attempts"] else "OPEN"
    rests = None if status != "OPEN" else at + timedelta(days=COOLDOWN_DAYS) if followed else old["cooldown_until"]
    return {
        **{c: found[c] for c in ("gap_id", "gap_type", "scope_type", "scope_id")}, "first_seen_run": old["first_seen_run"], "last_attempt_run": run_id if did else old["last_attempt_run"], "attempt_count": count, "status": status,
        "max_attempts": old["max_attempts"], "receipt_ids": sorted({*old["receipt_ids"], *(t["attempt_id"] for t in found["tries"])}), "resolution_receipt_id": success, "cooldown_until": rests,
    }


def _millis(at) -> int:
    return int(at.timestamp() * 1000)


class GapProcessor(StatefulProcessor):
    """One gap: its row, a timer for the end of its rest, and one for the end of its memory."""

    def __init__(self, keep_days: int):
        self.keep = timedelta(days=keep_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.gap = handle.getValueState("gap", GAP)

    def _now(self) -> dict | None:
        return dict(zip(FIELDS, self.gap.get(), strict=True)) if self.gap.exists() else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in sorted((r.asDict(recursive=True) for r in rows), key=lambda r: (r["run_at"], r["run_id"])):
            new = moved_on(self._now(), r, r["run_id"], r["run_at"])
            if new is None:
                continue
            self.gap.update(tuple(new[c] for c in FIELDS))
            until = new["cooldown_until"] if new["status"] == "OPEN" else r["run_at"] + self.keep
            if until is not None:
                self.handle.registerTimer(_millis(until))
            yield Row(kind=CHANGED, run_id=r["run_id"], **new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        gap, at = self._now(), expiredTimerInfo.getExpiryTimeInMs()
        if gap and gap["status"] == "OPEN" and gap["cooldown_until"] is not None and _millis(gap["cooldown_until"]) == at:
            yield Row(kind=DUE, run_id=gap["last_attempt_run"], **gap)
        last = max(self.handle.listTimers(), default=0) if gap and gap["status"] != "OPEN" else None
        if last is not None and last <= at:  # a gap that was opened and closed again since has a later timer
            self.gap.clear()
            yield Row(kind=FORGOTTEN, run_id=gap["last_attempt_run"], **gap)

    def close(self) -> None:
        pass


def gap_stream(evidence: DataFrame, late: str = "7 days", keep_days: int = 180) -> DataFrame:
    """A stream of OUT rows from a stream of a run's evidence with (run_id, run_at).

    Evidence of a gap has to come in the order of runs, but for what is within one batch. What is later than ``late``
    behind the newest run is dropped.  State holds open gaps, and closed ones for ``keep_days``.
    """
    return evidence.withWatermark("run_at", late).groupBy("gap_id").transformWithState(GapProcessor(keep_days), OUT, "Update", "EventTime")


class FirstOnly(StatefulProcessor):
    """The first row of a key, remembered for so many milliseconds."""

    def __init__(self, keep_ms: int, fields: list[str]):
        self.keep, self.fields = keep_ms, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "there boolean", self.keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            yield next(iter(rows))

    def close(self) -> None:
        pass


def first_only(stream: DataFrame, key: str, keep_days: int = 90) -> DataFrame:
    """Each key's first row; a key is forgotten, and new again, so many days after it came (by the machine's clock)."""
    shape = stream.schema
    return stream.groupBy(F.col(key)).transformWithState(FirstOnly(keep_days * 86_400_000, stream.columns), shape, "Append", "ProcessingTime")
