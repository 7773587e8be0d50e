"""The registered queries, each beside the SQL it is checked against."""

from tidalfed.plans import (  # noqa: F401
    aggregates,
    filters,
    joins,
    messages,
    network,
    projections,
    streams,
    training,
    windows,
)
from tidalfed.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
