"""Every named query over the driver's tables, with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit_queries, change_queries, claim_queries, desk_queries, layout_queries, page_queries, proposal_queries, record_queries, report_queries, respacing_queries, review_queries, stream_queries, table_queries

_PARTS = (audit_queries, review_queries, layout_queries, claim_queries, page_queries, desk_queries, proposal_queries, record_queries, report_queries, stream_queries, respacing_queries, change_queries, table_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
