"""Registered queries by survey section; importing this package fills the registry."""

from rowloom.plans import (aggregates, flagship, frames, joining, layouts, modelling, projections, samples,  # noqa: F401
                           scalar_functions, storage, windowing)
from rowloom.plans.registry import all_queries, all_sql  # noqa: F401
