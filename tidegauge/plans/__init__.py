"""Queries bound to the test tables; importing this package fills the registry."""

from tidegauge.plans import aggregations, changes, expressions, graphs, jobs, models, relations, storage, streams, tpch  # noqa: F401
