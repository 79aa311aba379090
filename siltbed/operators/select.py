"""Which rows move and which stay: eligible roots, dependents, complements.

All functions are lazy. Dependents are found by semi-joins on the parent key, so
a dependent's own age or status never matters and duplicates keep their number.
No join carries a broadcast hint: a first run may move most of a table, so the
size decides, at planning time or in AQE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.scalars import in_slice, older_than
from siltbed.spec import RunOptions, Tree


def scan(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The named columns in the named order; a missing one is an error."""
    if columns is None:
        return df
    require(df.columns, columns)
    return df.select(*columns)


def require(names: Sequence[str], columns: Sequence[str] | None) -> None:
    """Fail if a named column is missing."""
    missing = [c for c in columns or () if c not in names]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def eligible_filter(tree: Tree, options: RunOptions) -> Column:
    """Age rule, key slice and status rule of the root table."""
    rule = in_slice(tree.root.key, options.first_digit, options.last_digit)
    if tree.age_column:
        rule = older_than(tree.age_column, options.resolved_as_of(), tree.months, options.zone, tree.age_is_date) & rule
    if tree.status_column:
        rule = rule & F.col(tree.status_column).isin(*tree.statuses)
    return rule


def eligible_keys(tree: Tree, root: DataFrame, options: RunOptions) -> DataFrame:
    """One-column relation of eligible root keys."""
    return root.where(eligible_filter(tree, options)).select(tree.root.key)


def keys_from_list(df: DataFrame, array_column: str, key: str) -> DataFrame:
    """A key relation out of an array column."""
    return df.select(F.explode(array_column).alias(key))


def matching(rows: DataFrame, link: str, keys: DataFrame) -> DataFrame:
    """Rows whose link value is among the keys (first column of ``keys``)."""
    return _membership(rows, link, keys, "left_semi")


def not_matching(rows: DataFrame, link: str, keys: DataFrame) -> DataFrame:
    """The complement of ``matching``; rows with a NULL link are part of it."""
    return _membership(rows, link, keys, "left_anti")


def _membership(rows: DataFrame, link: str, keys: DataFrame, how: str) -> DataFrame:
    named = keys.select(F.col(keys.columns[0]).alias("__member"))
    return rows.join(named, rows[link] == named["__member"], how)


def moved_keys(tree: Tree, tables: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """Per table with dependents: the relation of its keys that move."""
    found = {tree.root.name: keys}
    for t in tree.dependents:
        if tree.children(t.name):
            rows = tables[t.name].select(t.key, t.link) if t.key != t.link else tables[t.name].select(t.key)
            found[t.name] = matching(rows, t.link, found[t.parent]).select(t.key)
    return found


def moved_rows(
    tree: Tree, tables: Mapping[str, DataFrame], keys: DataFrame, root_rule: Column | None = None
) -> dict[str, DataFrame]:
    """Per table: the rows that move, projected to the table's column list.

    ``root_rule`` may be given when the keys are exactly what it selects and the
    root key is unique: the root is then filtered instead of joined to itself.
    """
    parents = moved_keys(tree, tables, keys)
    out = {}
    for t in tree.tables:
        if t.parent is None:
            rows = (tables[t.name].where(root_rule) if root_rule is not None and t.unique
                    else matching(tables[t.name], t.key, keys))
        else:
            rows = matching(tables[t.name], t.link, parents[t.parent])
        out[t.name] = scan(rows, t.columns)
    return out


def kept_rows(tree: Tree, tables: Mapping[str, DataFrame], keys: DataFrame) -> dict[str, DataFrame]:
    """Per table: the rows that stay live, all their columns."""
    parents = moved_keys(tree, tables, keys)
    return {
        t.name: not_matching(tables[t.name], t.key if t.parent is None else t.link,
                             keys if t.parent is None else parents[t.parent])
        for t in tree.tables
    }


def split_by_rule(rows: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Moved and kept rows of one table by a predicate; NULL counts as kept."""
    moves = F.coalesce(rule, F.lit(False))
    return rows.where(rule), rows.where(~moves)
