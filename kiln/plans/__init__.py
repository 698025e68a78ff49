"""Named queries over the driver's test tables.

:mod:`kiln.plans.bindings` derives the inputs each family expects (log lines,
ratings, a graph, ...) from the parquet tables; :mod:`kiln.plans.catalog`
wires them to the operators; :mod:`kiln.plans.oracles` holds the matching
DuckDB SQL.
"""
