"""Whole jobs put together from the operators."""

from fixedrecon.plans.reconcile import ReconResult, ReconSpec, reconcile
from fixedrecon.plans.simple import SimpleSpec, reconcile_simple

__all__ = ["ReconResult", "ReconSpec", "SimpleSpec", "reconcile", "reconcile_simple"]
