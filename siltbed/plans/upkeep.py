"""Upkeep of a whole store after moves, once per table and not once per worker."""

from __future__ import annotations

from siltbed.plans import statistics
from siltbed.session import drop_scratch
from siltbed.sources.store import ARCHIVE, LIVE, Store

SCRATCH_HOURS = 48


def upkeep(store: Store, keep_versions: int = 2, scratch_hours: float = SCRATCH_HOURS) -> dict[str, int]:
    """Merge segments and ledger parts written in several pieces, refresh the statistics of
    tables with new parts, drop unreferenced versions and the scratch folders of runs that
    ended ``scratch_hours`` ago.

    Returns how many parts each table has now, how many were analysed and how many
    directories went.
    """
    for side in (LIVE, ARCHIVE):
        for table in store.snapshot().names(side):
            store.compact(side, table)
    store.compact_ledger()
    m = store.snapshot()
    analysed = sum(statistics.refresh(store, side, t, m) for side in (LIVE, ARCHIVE) for t in m.names(side))
    counts = {f"{side}/{t}": len(m.of(side, t)) for side in (LIVE, ARCHIVE) for t in m.names(side)}
    return {**counts, "analysed": analysed, "dropped": len(store.expire(keep_versions)), "scratch": drop_scratch(store.spark, scratch_hours)}
