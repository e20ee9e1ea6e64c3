"""All registered queries."""

from __future__ import annotations

from tidemill.plans import collect_queries, flow_queries, pay_queries, quality_queries, shop_queries
from tidemill.plans.query import Query

_MODULES = (shop_queries, pay_queries, collect_queries, quality_queries, flow_queries)

QUERIES: dict[str, Query] = {query.key: query for module in _MODULES for query in module.QUERIES}
