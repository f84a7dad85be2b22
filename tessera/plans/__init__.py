"""Queries over the driver tables, one or more per operator of SURVEY section 2."""

from tessera.plans import (  # noqa: F401  (registration)
    extra_plans, graph_plans, io_plans, metric_plans, model_plans, ordered_plans, relational_plans, text_plans,
    timeseries_plans,
)
from tessera.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
