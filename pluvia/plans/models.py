"""Models as a declared graph: SQL with named references, or a function of its sources.

A reference ``{name}`` in a model's SQL is an edge of the graph, so the order of building
follows from the models themselves.  Views are kept in the catalog and outlive the
session; tables are rebuilt whole.  (Spark's declarative pipelines run behind a Connect
server, which this library does not start.)
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.operators import marts as M


@dataclass(frozen=True)
class Model:
    """``sql`` (a ``view`` or ``table``), or ``build`` from the frames of ``sources`` (a table)."""
    name: str
    sql: str | None = None
    build: Callable[..., DataFrame] | None = None
    sources: tuple[str, ...] = ()
    kind: str = "table"

    def references(self) -> set[str]:
        named = {f for _, f, _, _ in string.Formatter().parse(self.sql) if f} if self.sql else set()
        return named | set(self.sources)


class ModelGraph:
    def __init__(self, models: Iterable[Model]):
        self.models: dict[str, Model] = {}
        for m in models:
            if m.name in self.models:
                raise ValueError(f"two models are named {m.name}")
            if (m.sql is None) == (m.build is None) or m.kind not in ("view", "table") or (m.build and m.kind == "view"):
                raise ValueError(f"model {m.name}: a view or table of SQL, or a table that a function builds")
            self.models[m.name] = m

    def order(self, sources: Iterable[str], wanted: Iterable[str] | None = None) -> list[str]:
        """The models in an order in which each follows what it reads (all, or those that
        ``wanted`` needs).  A reference that is neither a model nor a source, and a
        cycle, raise."""
        known, chosen = set(sources), set()
        todo = list(self.models if wanted is None else wanted)
        while todo:
            name = todo.pop()
            if name in chosen or name in known and name not in self.models:
                continue
            if name not in self.models:
                raise ValueError(f"no model or source is named {name}")
            chosen.add(name)
            for ref in sorted(self.models[name].references()):
                if ref not in self.models and ref not in known:
                    raise ValueError(f"model {name} reads {ref}, which is no model and no source")
                todo.append(ref)
        graph = {n: sorted(r for r in self.models[n].references() if r in self.models) for n in sorted(chosen)}
        try:
            return list(TopologicalSorter(graph).static_order())
        except CycleError as e:
            raise ValueError(f"models read each other: {' -> '.join(e.args[1])}") from e

    def downstream(self, changed: Iterable[str]) -> set[str]:
        """The models that read any of ``changed``, directly or not."""
        out, todo = set(), set(changed)
        while todo:
            near = {m.name for m in self.models.values() if m.references() & todo} - out
            out |= near
            todo = near
        return out

    def run(self, spark: SparkSession, database: str, sources: Mapping[str, str],
            wanted: Iterable[str] | None = None) -> list[str]:
        """Build the models in ``database``; ``sources`` gives each source's table in the
        catalog.  Returns the qualified names in the order of building."""
        names = {**sources, **{n: f"{database}.{n}" for n in self.models}}
        built = []
        for name in self.order(sources, wanted):
            m, target = self.models[name], names[name]
            if m.sql is not None:
                text = m.sql.format(**{r: names[r] for r in m.references()})
                if m.kind == "view":
                    spark.sql(f"CREATE OR REPLACE VIEW {target} AS {text}")
                else:
                    spark.sql(text).write.mode("overwrite").saveAsTable(target)
            else:
                m.build(*[spark.table(names[s]) for s in m.sources]).write.mode("overwrite").saveAsTable(target)
            built.append(target)
        return built


def staging_sql(source: str = "{fact_weather}") -> str:
    """The staging view as SQL: what :func:`pluvia.operators.marts.staging` gives."""
    def column(c: str) -> str:
        if c in ("latitude", "longitude"):
            return f"round(`{c}`, 4) AS `{c}`"
        if c in ("precipitation_sum", "precipitation_hours"):
            return f"coalesce(`{c}`, 0.0D) AS `{c}`"
        return f"`{c}`"

    columns = ", ".join(column(c) for c in M.STAGING_COLUMNS)
    return f"SELECT {columns} FROM {source} WHERE `date` IS NOT NULL AND `city_name` IS NOT NULL"


def daily_models(window_days: int | None = None, as_of=None) -> ModelGraph:
    """M1 -> M2 -> M3: the staging view, the daily summary and the statistics."""
    return ModelGraph([
        Model("mart_city_stats", build=lambda d: M.city_stats(d, window_days=window_days, as_of=as_of),
              sources=("mart_daily_summary",)),
        Model("mart_daily_summary", build=M.daily_summary, sources=("stg_weather",)),
        Model("stg_weather", sql=staging_sql(), kind="view"),
    ])


def row_counts(spark: SparkSession, names: Iterable[str]) -> dict[str, int]:
    return {n: spark.table(n).agg(F.count(F.lit(1))).first()[0] for n in names}
