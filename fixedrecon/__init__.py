"""fixedrecon: checks fixed-width extracts against each other on Spark."""

from fixedrecon.layout import Layout, LayoutField, collect_layout, layout_from_tuples
from fixedrecon.operators.compare import Rules, make_rules
from fixedrecon.operators.layout import parse_copybooks
from fixedrecon.operators.records import read_fixed_width
from fixedrecon.plans import ReconSpec, SimpleSpec, reconcile, reconcile_simple
from fixedrecon.sources import scan_copybooks, scan_lines, scan_tuple_layout

__all__ = [
    "Layout", "LayoutField", "ReconSpec", "Rules", "SimpleSpec", "collect_layout",
    "layout_from_tuples", "make_rules", "parse_copybooks", "read_fixed_width", "reconcile",
    "reconcile_simple", "scan_copybooks", "scan_lines", "scan_tuple_layout",
]
