"""Statistics of a store's tables, kept as sketches per part.

Parts never change, so a part is read for its sketches once; a run only adds the parts
it wrote, and a table's statistics are a merge of one small row per part and column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.sketches import column_sketches, estimates, merged
from siltbed.sources.store import OWN, Manifest, Part, Store, by_batches

FILE, PART = f"{OWN}file", "part"


def _folder(store: Store, side: str, table: str) -> str:
    return f"{store.root}/statistics/{side}/{table}"


def _part_of(file: Column, parts: list[Part], store: Store) -> Column:
    """The name of the part a file belongs to, by its own path or that of a folder above it."""
    bare = lambda path: F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    steps = F.split(F.regexp_replace(bare(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))), "/+", "/"), "/")
    above = F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    names = _names(parts)
    known = F.create_map(*[x for p in {p.path: p for p in parts}.values() for x in (F.regexp_replace(bare(F.lit(store.locate(p))), "/+", "/"), F.lit(names[p.path]))])
    return F.element_at(F.filter(F.transform(above, lambda a: known[a]), lambda p: p.isNotNull()), 1)


def _names(parts: Iterable[Part]) -> dict[str, str]:
    """What the sketches of a directory are kept under: its path, with the batches that count where not all do."""
    return {p.path: p.path + "".join(f"#{a}-{b if b is not None else ''}" for a, b in batches)
            for batches, group in by_batches(parts).items() for p in group}


def _known(store: Store, side: str, table: str) -> DataFrame | None:
    folder = _folder(store, side, table)
    return store.spark.read.parquet(folder) if store.has(folder) else None


def refresh(store: Store, side: str, table: str, manifest: Manifest | None = None) -> int:
    """Sketch the parts of a table that have no sketches yet; how many there were."""
    manifest = manifest or store.snapshot()
    parts = list(manifest.of(side, table))
    known = _known(store, side, table)
    done = {r[0] for r in known.select(PART).distinct().collect()} if known is not None else set()
    names = _names(parts)
    new = [p for p in parts if names[p.path] not in done]
    if new:
        rows = store.read(manifest, side, table, new, with_file=FILE)
        found = column_sketches(rows, by=[FILE])
        by_part = merged(found.withColumn(PART, _part_of(F.col(FILE), new, store)), by=[PART])
        by_part.coalesce(1).write.mode("append").parquet(_folder(store, side, table))
    return len(new)


def statistics(store: Store, side: str, *tables: str) -> DataFrame:
    """Estimates per column of tables, from the sketches of their present parts."""
    return estimates(sketches_of(store, side, *tables))


def sketches_of(store: Store, side: str, *tables: str) -> DataFrame:
    """Merged sketches of the present parts of tables with the same columns."""
    out = None
    for table in tables:
        paths = list(_names(store.snapshot().of(side, table)).values())
        known = _known(store, side, table)
        if known is None:
            raise ValueError(f"{side} {table} has no statistics, call refresh")
        own = known.where(F.col(PART).isin(paths))
        out = own if out is None else out.unionByName(own)
    return merged(out)
