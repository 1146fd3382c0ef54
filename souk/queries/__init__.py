"""Registered queries over the stored tables, and equivalent SQL where it can be written."""

from souk.queries import features, models, operations, ranking, statistics, streams

_GROUPS = (features, statistics, ranking, operations, streams, models)

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
