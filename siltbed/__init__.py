"""siltbed: retention and archiving of record trees as Spark jobs."""

from siltbed.spec import RunOptions, Table, Tree

__all__ = ["RunOptions", "Table", "Tree"]
