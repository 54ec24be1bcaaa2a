"""The star schema handed to every KPI, question, analysis and report.

Tables are lazy and built on first use; views derived from a model are plans, so each is
described once per model and shared by everything that asks for it.
"""

from __future__ import annotations

import copy
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attain.policy import Policy, plan_months, tier_bands
from attain.sources.stage import store

TABLES = ("tiers", "fact_sales", "fact_targets", "fact_team_plan", "bridge", "dim_team", "dim_country",
          "dim_department", "dim_employee", "dim_product", "dim_customer")


class Model:
    policy: Policy
    tiers: DataFrame
    fact_sales: DataFrame
    fact_targets: DataFrame
    fact_team_plan: DataFrame
    bridge: DataFrame
    dim_team: DataFrame
    dim_country: DataFrame
    dim_department: DataFrame
    dim_employee: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame

    def __init__(self, policy: Policy, staged: bool = False, **tables: DataFrame):
        self.policy, self.staged, self.folder = policy, staged, None
        self.__dict__.update(tables)
        self._views: dict = {}

    @property
    def spark(self) -> SparkSession:
        return self.fact_sales.sparkSession

    @property
    def plan_months(self) -> DataFrame:
        return plan_months(self.tiers)

    @property
    def tier_bands(self) -> DataFrame:
        return tier_bands(self.tiers)

    def with_(self, **changes) -> "Model":
        """The same model with some tables (or the policy) exchanged."""
        other = copy.copy(self)
        other.__dict__.update(changes)
        other._views = {}
        return other


def view(function: Callable[..., DataFrame] | None = None, *, stage: list[str] | None = None):
    """Describe a derived view once per model; with ``stage`` a staged model also writes it once,
    sorted by the given columns inside its files."""
    if function is None:
        return functools.partial(view, stage=stage)

    @functools.wraps(function)
    def described(m: Model, *args, **options) -> DataFrame:
        key = (function.__name__, args, tuple(sorted(options.items())))
        if key not in m._views:
            df = function(m, *args, **options)
            m._views[key] = store(df, function.__name__, stage, m.folder) if stage and m.staged else df
        return m._views[key]

    return described
