"""All registered queries: importing the modules fills the registry."""

from . import audit, extended, reports, tables  # noqa: F401
from .core import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
