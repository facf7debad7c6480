"""Every operator as a query over the test tables, with the SQL it has to agree with."""

from tillroll.registry import columns, jobs, joins, scans
from tillroll.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "columns", "jobs", "joins", "scans"]
