"""Every checked query; importing the modules registers them."""

from bitextloom.catalog import columns, reports, runs, scans  # noqa: F401
from bitextloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
