"""Relational operators of the lakehouse: silver projections, gold star schema,
incremental merge, quality checks."""
