"""All registered queries."""

from . import dim_queries, fleet_queries, learn_queries, nightly_queries, panel_queries, rollup_queries, store_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
