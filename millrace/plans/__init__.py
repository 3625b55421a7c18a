"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from millrace.plans.registry import REGISTRY, register  # noqa: F401


def load_all() -> dict:
    from millrace.plans import (  # noqa: F401
        aggregates, checks, engine, evolution, filters, folding, projections, sinks, sources,
        streams, telemetry, transactions, transforms,
    )
    return REGISTRY
