"""Queries over tables and the SQL they are checked against."""
