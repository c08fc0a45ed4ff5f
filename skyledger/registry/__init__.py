"""The operators as named queries over the driver tables, each with its SQL twin."""

from skyledger.registry.oracles import oracle_queries
from skyledger.registry.queries import registered_queries

__all__ = ["oracle_queries", "registered_queries"]
