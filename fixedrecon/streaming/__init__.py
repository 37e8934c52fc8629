"""Checks on files as they arrive."""

from fixedrecon.streaming.arrivals import check_arrivals, compare_arrivals
from fixedrecon.streaming.prepared import PreparedLegacy, prepare_legacy, prepared_legacy

__all__ = ["PreparedLegacy", "check_arrivals", "compare_arrivals", "prepare_legacy", "prepared_legacy"]
