"""Generic DataFrame operators: selection, rules, joins, reshaping, totals, windows."""
