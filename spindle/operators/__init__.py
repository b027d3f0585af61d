"""DataFrame operators: index build and merge, ranking, evaluation, joins."""
