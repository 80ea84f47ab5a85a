"""All queries of the engine by name, and their DuckDB forms."""

from . import aggregate_queries, booking_queries, event_queries, forecast_queries, history_queries, join_queries, linkage_queries, panel_queries, product_queries, profile_queries, source_queries, stream_queries, survival_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
