"""DataFrame operators: column shaping, joins, de-duplication, pivots, ordering."""
