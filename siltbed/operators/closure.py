"""Dependents at any depth in a graph of links: several parents, links of a table to itself, cycles.

A tree moves level by level; a graph has no levels. Starting from chosen keys, each round
takes only the keys found in the round before (the frontier), finds the rows that refer
to them by semi-joins on the link columns, and keeps the keys not seen yet. A row in a
cycle is seen once, so rounds end when nothing new is found.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.session import stage

KEY = "__key"


@dataclass(frozen=True)
class Link:
    """``child.column`` refers to the key of ``parent``."""

    child: str
    column: str
    parent: str


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias(KEY)).where(F.col(KEY).isNotNull())


def closure_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str], links: Sequence[Link],
                 start: Mapping[str, DataFrame], max_rounds: int = 0) -> dict[str, DataFrame]:
    """Per table with a key in ``keys``: the distinct keys reached from ``start``.

    ``start`` gives a one-column relation of keys for some of the tables; keys without a
    row count too, for rows may refer to them. Null links refer to nothing. Each round's
    new keys are written to the shared folder, so plans don't grow. More than
    ``max_rounds`` rounds (0: any number) are an error.
    """
    for link in links:
        if link.parent not in keys:
            raise ValueError(f"{link.parent} has no key for {link.child}.{link.column} to refer to")
    frontier = {t: stage(_keys(df, df.columns[0]).distinct(), "closure") for t, df in start.items()}
    seen = dict(frontier)
    rounds = 0
    while frontier:
        rounds += 1
        if max_rounds and rounds > max_rounds:
            raise RuntimeError(f"links go deeper than {max_rounds} rounds")
        found: dict[str, list[DataFrame]] = {}
        for link in links:
            if link.parent in frontier and link.child in keys:
                rows = tables[link.child].select(F.col(link.column).alias("__link"), F.col(keys[link.child]).alias(KEY))
                up = frontier[link.parent].withColumnRenamed(KEY, "__up")
                found.setdefault(link.child, []).append(
                    rows.join(up, F.col("__link") == F.col("__up"), "left_semi").select(KEY).where(F.col(KEY).isNotNull()))
        frontier = {}
        for t, parts in found.items():
            new = reduce(DataFrame.unionByName, parts).distinct()
            if t in seen:
                new = new.join(seen[t], KEY, "left_anti")
            new = stage(new, "closure")
            if not new.isEmpty():
                frontier[t] = new
        for t, new in frontier.items():
            seen[t] = seen[t].unionByName(new) if t in seen else new
    return seen


def closure_rows(tables: Mapping[str, DataFrame], keys: Mapping[str, str], links: Sequence[Link],
                 start: Mapping[str, DataFrame], max_rounds: int = 0) -> dict[str, DataFrame]:
    """Per table the rows reached from ``start``, each as often as the table has it.

    A table without a key of its own, to which nothing can refer, is reached by any of its links.
    """
    seen = closure_keys(tables, keys, links, start, max_rounds)
    out = {}
    for t, df in tables.items():
        if t in keys:
            known = [(keys[t], seen[t])] if t in seen else []
        else:
            known = [(link.column, seen[link.parent]) for link in links if link.child == t and link.parent in seen]
        if not known:
            out[t] = df.where(F.lit(False))
        elif len(known) == 1:
            out[t] = df.join(known[0][1], df[known[0][0]] == F.col(KEY), "left_semi")
        else:
            flagged = df
            for i, (column, found) in enumerate(known):
                flagged = flagged.join(found.select(F.col(KEY).alias(f"{KEY}{i}")), df[column] == F.col(f"{KEY}{i}"), "left")
            any_of = reduce(lambda a, b: a | b, [F.col(f"{KEY}{i}").isNotNull() for i in range(len(known))])
            out[t] = flagged.where(any_of).select(*[df[c] for c in df.columns])
    return out
