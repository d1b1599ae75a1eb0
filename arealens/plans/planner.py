"""Catalogue rows as jobs: rows that share their parameters run as one keyed batch.

A batch is one plan with ``ind_id`` as a group key: one roll-up, one
population join and one window pass for all its rows.  Rows of one dataset
share its scan (the ids are exploded on it), several datasets are stacked.
Rows whose parameters differ are plans of their own in the same result.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import union_all
from .catalogue import CatalogueEntry
from .runner import Job, run_jobs
from .spec import IndicatorSpec


@dataclasses.dataclass(frozen=True)
class Batch:
    """Rows that one plan can run: their spec (without an id), population and (dataset, ids)."""

    spec: IndicatorSpec
    pop: str | None
    datasets: tuple[tuple[str, tuple[int, ...]], ...]

    @property
    def ind_ids(self) -> list[int]:
        return [i for _, ids in self.datasets for i in ids]


def batches(entries: list[CatalogueEntry], yearstart: int | None = None, yearend: int | None = None,
            geography: str | None = None) -> list[Batch]:
    """Indicator rows grouped by everything that shapes their plan; inequality rows and rows without an id are refused."""
    found: dict[tuple, dict[str, list[int]]] = {}
    for e in entries:
        if e.stage != "second" or e.ind_id is None:
            raise ValueError(f"{e.dataset}/{e.stage}: not an indicator row")
        spec = dataclasses.replace(e.to_spec(yearstart, yearend, geography), ind_id=0)
        key = (dataclasses.astuple(dataclasses.replace(spec, filters={}))[:-1], e.pop)
        group = found.setdefault((repr(key), e.pop), {"spec": spec, "sets": {}})
        ids = group["sets"].setdefault(e.dataset, [])
        if e.ind_id in [i for got in group["sets"].values() for i in got]:
            raise ValueError(f"indicator {e.ind_id} is listed twice with the same parameters")
        ids.append(e.ind_id)
    return [Batch(g["spec"], pop, tuple((d, tuple(ids)) for d, ids in g["sets"].items())) for (_, pop), g in found.items()]


def jobs(plan: list[Batch], sources: dict[str, DataFrame], lookup: DataFrame | None, base_col: str, level_cols,
         populations: dict[str, DataFrame] | None = None) -> list[Job]:
    """A keyed job for each batch; datasets or populations that are not given are an error."""
    out = []
    for b in plan:
        if b.pop is not None and b.pop not in (populations or {}):
            raise ValueError(f"no population {b.pop}")
        parts = []
        for name, ids in b.datasets:
            if name not in sources:
                raise ValueError(f"no dataset {name}")
            parts.append(sources[name].withColumn("ind_id", F.explode(F.array(*[F.lit(i) for i in ids]))))
        out.append(Job(b.spec, union_all(parts, allow_missing=True), lookup, base_col, list(level_cols),
                       population=populations[b.pop] if b.pop is not None else None, keyed=True, ind_ids=b.ind_ids))
    return out


def run_catalogue(entries: list[CatalogueEntry], sources: dict[str, DataFrame], lookup: DataFrame | None, base_col: str,
                  level_cols, populations: dict[str, DataFrame] | None = None, **given) -> DataFrame:
    """The published rows of all entries, in the fixed columns."""
    return run_jobs(jobs(batches(entries, **given), sources, lookup, base_col, level_cols, populations))
