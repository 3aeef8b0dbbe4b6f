"""Name → (query, oracle SQL) register shared by the binding modules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, query: Query, oracle: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query registered twice: {name}")
        self.queries[name] = query
        if oracle is not None:
            self.oracles[name] = oracle

    def entry(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.add(name, query, oracle)
            return query

        return register
