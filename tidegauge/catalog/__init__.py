"""Registered queries over the given tables, each with its SQL equivalent where there is one."""

from tidegauge.catalog import drift, loads, series, streams, text, totals

_MODULES = (totals, loads, series, streams, text, drift)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
