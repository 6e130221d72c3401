"""Registration of Python models and their dependency order.

A model is a function ``(dag, spark) -> DataFrame`` (or a pandas frame for small
results). Calling :meth:`Dag.ref` builds the lazy plan of a dependency once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Model = Callable[["Dag", SparkSession], Any]


class Dag:
    """Named models, named sources and settings; results are lazy DataFrames."""

    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame] | None = None,
                 config: dict[str, Any] | None = None):
        self.spark = spark
        self.config = dict(config or {})
        self._sources = dict(sources or {})
        self._models: dict[str, Model] = {}
        self._built: dict[str, DataFrame] = {}
        self._building: list[str] = []

    def model(self, name: str | None = None) -> Callable[[Model], Model]:
        """Decorator that registers a model under its function name."""

        def add(fn: Model) -> Model:
            self._models[name or fn.__name__] = fn
            return fn

        return add

    def source(self, name: str) -> DataFrame:
        return self._sources[name]

    def ref(self, name: str) -> DataFrame:
        """DataFrame of a model, built at most once per Dag."""
        if name not in self._built:
            if name in self._building:
                raise ValueError("cycle: " + " -> ".join([*self._building, name]))
            self._building.append(name)
            try:
                result = self._models[name](self, self.spark)
                self._built[name] = result if isinstance(result, DataFrame) else self.spark.createDataFrame(result)
            finally:
                self._building.pop()
        return self._built[name]

    def names(self) -> list[str]:
        return sorted(self._models)
