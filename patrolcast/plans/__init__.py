"""Registered queries (one per operator of the inventory) and their DuckDB twins."""

from .common import REGISTRY, QuerySpec


def load_all() -> dict:
    """Import every query module so it registers itself."""
    from . import q_closed, q_data, q_models  # noqa: F401
    return REGISTRY


__all__ = ["REGISTRY", "QuerySpec", "load_all"]
