"""Every operator as a query over the test tables, with its SQL twin."""

from . import cleaning, customers, geography, quality, reports, segments, star, storage, targets
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
