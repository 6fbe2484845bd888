"""Transformation hooks: per table, an ordered chain of DataFrame functions run before a load."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame

Hook = Callable[[DataFrame], DataFrame]


class Hooks:
    """Registered hooks. A hook may change records or drop them by filtering."""

    def __init__(self) -> None:
        self._chains: dict[str, list[Hook]] = defaultdict(list)

    def register(self, table: str, hook: Hook) -> None:
        self._chains[table].append(hook)

    def __contains__(self, table: str) -> bool:
        return bool(self._chains.get(table))

    def copy(self) -> Hooks:
        other = Hooks()
        for table, chain in self._chains.items():
            other._chains[table] = list(chain)
        return other

    def apply(self, table: str, records: DataFrame) -> DataFrame:
        """Run the chain of a table in registration order, then drop records with no key."""
        for hook in self._chains[table]:
            records = records.transform(hook)
        return records.filter(records["id"].isNotNull())
