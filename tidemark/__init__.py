"""Tidemark: change capture, quality gates and cohort analytics for event-sourced portfolios, on plain Spark."""
