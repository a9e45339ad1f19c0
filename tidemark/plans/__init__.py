"""Marts, and the queries registered over the given tables."""
