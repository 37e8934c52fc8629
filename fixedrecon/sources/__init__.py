"""Readers for record files and copybooks."""

from fixedrecon.sources.copybooks import copybook_lines, scan_copybooks, write_copybook_libraries
from fixedrecon.sources.records import scan_lines, scan_tuple_layout

__all__ = ["copybook_lines", "scan_copybooks", "scan_lines", "scan_tuple_layout", "write_copybook_libraries"]
