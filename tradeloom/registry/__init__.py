"""All registered queries and the SQL that must give the same rows."""

from . import check_queries, kpi_queries, mart_queries, warehouse_queries

_MODULES = (mart_queries, kpi_queries, check_queries, warehouse_queries)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
