"""A registry of models: each names what it reads, how it is stored and how it merges; a runner builds them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from spanweave.operators.checks import Expectations
from spanweave.operators.partitions import merge_partitions, read_partitions
from spanweave.operators.tables import table_exists, upsert_coalesce, upsert_replace, write_version


@dataclass(frozen=True)
class Model:
    """``stored``: table (replaced whole), incremental (merged by keys), view (a temporary view) or inline (only a DataFrame).

    ``by``: an incremental table in partitions by these columns, of which a run rewrites only those it touches. ``expects``: what a stored table must be like;
    one that isn't isn't put in place, and the run ends.
    """

    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    stored: str = "inline"
    keys: tuple[str, ...] = ()
    merge: str = "replace"
    layer: str = "analytics"
    by: tuple[str, ...] = ()
    expects: Expectations = Expectations()


@dataclass
class Warehouse:
    """Tables as Parquet folders, <root>/<layer>/<name>."""

    spark: SparkSession
    root: str
    models: dict[str, Model] = field(default_factory=dict)

    def add(self, model: Model) -> None:
        if model.name in self.models:
            raise ValueError(f"model {model.name} is defined twice")
        self.models[model.name] = model

    def path(self, model: Model) -> str:
        return f"{self.root}/{model.layer}/{model.name}"

    def order(self, targets: Iterable[str]) -> list[str]:
        """The targets and all they read, each after what it reads."""
        graph: dict[str, tuple[str, ...]] = {}
        todo = list(targets)
        while todo:
            name = todo.pop()
            if name in graph or name not in self.models:
                continue
            graph[name] = tuple(d for d in self.models[name].reads if d in self.models)
            todo += graph[name]
        return list(TopologicalSorter(graph).static_order())

    def run(self, targets: Iterable[str], inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Build the targets with their ancestors; returns every model built."""
        built = dict(inputs)
        for name in self.order(targets):
            model = self.models[name]
            out = model.build(*(built[d] for d in model.reads))
            if model.stored == "view":
                out.createOrReplaceTempView(name)
            elif model.stored in ("table", "incremental"):
                out = self._write(model, out)
            built[name] = out
        return built

    def _write(self, model: Model, out: DataFrame) -> DataFrame:
        path = self.path(model)
        merge = upsert_coalesce if model.merge == "coalesce" else upsert_replace
        if model.stored == "incremental" and model.by:
            merge_partitions(out, path, model.keys, model.by, merge, expects=model.expects)
            return read_partitions(self.spark, path)
        if model.stored == "incremental" and table_exists(self.spark, path):
            out = merge(self.spark.read.parquet(path), out, list(model.keys))
        write_version(out, path, model.expects)
        return self.spark.read.parquet(path)
