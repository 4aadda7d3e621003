"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it; ``tessera.llm.registry`` lists the
registered queries and their SQL.
"""
