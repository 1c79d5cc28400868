"""DataFrame operators: filters, joins, ordering, splits, metrics, models."""
