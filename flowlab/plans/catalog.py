"""Imports every query module so that the registry is complete."""

from __future__ import annotations

from flowlab.plans import (  # noqa: F401
    cluster_queries,
    learning_queries,
    model_queries,
    packet_queries,
    stream_queries,
    table_queries,
)
from flowlab.plans import registry


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.SQL)
