"""The model graph: raw -> staging -> (dim_species, fct_daily) for one input.

``Models`` is a lazy bundle: each model is planned on first access and
nothing runs until a consumer triggers an action.  ``occurra.plans.pipeline``
materialises the marts so that serving queries and checks read small tables
instead of re-deriving them - the role full-refresh mart tables play in the
source system.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from occurra.operators.marts import build_dim_species, build_fct_daily
from occurra.operators.staging import build_staging


class Models:
    """``stg`` / ``dim`` / ``fct`` are derived on first use unless given
    (e.g. marts already materialised as tables)."""

    def __init__(
        self,
        raw: DataFrame,
        stg: DataFrame | None = None,
        dim: DataFrame | None = None,
        fct: DataFrame | None = None,
    ):
        self.raw = raw
        for name, df in (("stg", stg), ("dim", dim), ("fct", fct)):
            if df is not None:
                self.__dict__[name] = df  # pre-fills the cached property

    @cached_property
    def stg(self) -> DataFrame:
        return build_staging(self.raw)

    @cached_property
    def dim(self) -> DataFrame:
        return build_dim_species(self.stg)

    @cached_property
    def fct(self) -> DataFrame:
        return build_fct_daily(self.stg)

    def tables(self) -> dict[str, DataFrame]:
        """Tables keyed by model name (as used by the quality checks)."""
        return {
            "gbif_observations_raw": self.raw,
            "stg_belgian_birds": self.stg,
            "dim_species": self.dim,
            "fct_daily_species_observations": self.fct,
        }


def build_models(raw: DataFrame) -> Models:
    return Models(raw)
