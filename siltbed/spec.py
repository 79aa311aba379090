"""What to archive (tables and how they hang together) and how to bound a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    """One table of a record tree.

    ``key`` is the row id and ``unique`` says whether it identifies one row.
    ``parent``/``link`` name the parent table and the column that holds its key;
    both are ``None`` for the root. ``columns`` limits the move to a named list,
    ``None`` moves every column the live table has.

    ``span`` is the width of one storage segment: this many consecutive link
    values (root: key values) share a segment, so a run that moves old keys
    touches few segments. A table with an age rule is segmented by month instead.
    """

    name: str
    key: str
    unique: bool = True
    parent: str | None = None
    link: str | None = None
    columns: tuple[str, ...] | None = None
    span: int = 10_000_000

    def __post_init__(self):
        if (self.parent is None) != (self.link is None):
            raise ValueError(f"{self.name}: parent and link go together")
        if self.span < 1:
            raise ValueError(f"{self.name}: span must be positive")


@dataclass(frozen=True)
class Tree:
    """A root table, the rule that makes its rows eligible, and its dependents.

    Dependents are listed parents first; any depth is allowed. A root with an age
    rule is stored in segments of ``segment_months`` months of that age.
    """

    root: Table
    dependents: tuple[Table, ...] = ()
    age_column: str | None = None
    months: int = 0
    status_column: str | None = None
    statuses: tuple[str, ...] = ()
    age_is_date: bool = False
    segment_months: int = 1

    def __post_init__(self):
        if self.root.parent is not None:
            raise ValueError("the root table has no parent")
        if self.segment_months < 1:
            raise ValueError("segment_months must be positive")
        if (self.status_column is None) != (not self.statuses):
            raise ValueError("status_column and statuses go together")
        seen = {self.root.name}
        for t in self.dependents:
            if t.parent not in seen:
                raise ValueError(f"{t.name}: parent {t.parent!r} must be listed before it")
            if t.name in seen:
                raise ValueError(f"{t.name} is listed twice")
            seen.add(t.name)

    @property
    def tables(self) -> tuple[Table, ...]:
        return (self.root, *self.dependents)

    def children(self, name: str) -> tuple[Table, ...]:
        return tuple(t for t in self.dependents if t.parent == name)

    def table(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)


@dataclass(frozen=True)
class RunOptions:
    """Bounds of one run. Zero means "no limit" for the three limits.

    ``parallel`` is the number of workers the ten last digits are split over;
    it names slices for accounting, the Spark tasks are not limited to it.
    ``chunk_batches`` is the number of batches (per worker) published at once.
    ``audit_contents`` reads all touched and written parts once more before a chunk is
    published, and fails the run if a row is not on one side as it was.
    """

    as_of: dt.date | None = None
    parallel: int = 1
    first_digit: int = 0
    last_digit: int = 9
    batch_size: int = 20
    max_batches: int = 0
    time_limit_sec: int = 0
    chunk_batches: int = 0
    zone: str = "UTC"
    run_id: str | None = None
    audit_contents: bool = False

    def __post_init__(self):
        object.__setattr__(self, "parallel", min(max(self.parallel, 1), 10))
        if not 0 <= self.first_digit <= self.last_digit <= 9:
            raise ValueError("digits must satisfy 0 <= first <= last <= 9")
        if self.batch_size < 1:
            raise ValueError("batch_size must be positive")
        if min(self.max_batches, self.time_limit_sec, self.chunk_batches) < 0:
            raise ValueError("limits must not be negative")

    def resolved_as_of(self) -> dt.date:
        """The run date: given, or today's calendar date in the run's zone."""
        if self.as_of is not None:
            return self.as_of
        from zoneinfo import ZoneInfo

        return dt.datetime.now(ZoneInfo(self.zone)).date()
