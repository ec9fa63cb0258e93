"""DataFrame -> DataFrame operators (projections, filters, joins, aggregates, windows, checks)."""
