"""Registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ("core", "health_q", "compliance_q", "maintenance_q", "source_q")


def load():
    """All registered queries by key."""
    from fleetwatch.queries import registry

    for name in MODULES:
        import_module(f"fleetwatch.queries.{name}")
    return registry.QUERIES
