"""Every operator as a named query over the driver's tables, with oracle SQL."""

from . import cleaning, files, star  # noqa: F401  (register their queries)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
