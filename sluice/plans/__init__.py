"""Compositions: the table jobs and the registered queries."""
