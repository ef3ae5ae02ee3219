"""The annotated matrix as a handful of tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SpatialDataset:
    """Long tables keyed by ``sample_id`` / ``obs_id`` / ``var_id``.

    ``counts`` holds non-zeros only, one row per (spot, gene). ``extras`` holds result tables by name
    (edges, clusters, markers, ...).
    """

    obs: DataFrame
    var: DataFrame
    counts: DataFrame
    images: DataFrame | None = None
    scalefactors: DataFrame | None = None
    extras: dict[str, DataFrame] = field(default_factory=dict)

    def with_(self, **tables: DataFrame) -> "SpatialDataset":
        """Copy with the named core tables replaced and other names stored as extras."""
        core = {k: v for k, v in tables.items() if k in ("obs", "var", "counts", "images", "scalefactors")}
        rest = {k: v for k, v in tables.items() if k not in core}
        return replace(self, **core, extras={**self.extras, **rest})

    def tables(self) -> dict[str, DataFrame]:
        core = {"obs": self.obs, "var": self.var, "counts": self.counts}
        optional = {"images": self.images, "scalefactors": self.scalefactors}
        return {**core, **{k: v for k, v in optional.items() if v is not None}, **self.extras}
