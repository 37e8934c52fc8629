"""DataFrame operators: copybooks, layouts, records, quality, comparison, metrics."""
