"""Queries over the given test tables and the SQL they must agree with."""
