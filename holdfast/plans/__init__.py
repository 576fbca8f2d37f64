"""Compositions of operators: the batch job and the query catalogue."""
