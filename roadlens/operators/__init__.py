"""DataFrame -> DataFrame operators (filters, spatial joins, joins,
aggregates, ranking, quality checks, splits, evaluation, learning)."""
