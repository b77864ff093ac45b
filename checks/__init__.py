"""The registered queries, each with the SQL whose result it must equal."""

from checks.registry import ORACLES, QUERIES
from checks import (  # noqa: F401  (each module registers its queries)
    drift, ledgers, loads, repeats, reports, scans, streams,
)

__all__ = ["ORACLES", "QUERIES"]
