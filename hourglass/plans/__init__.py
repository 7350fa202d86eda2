"""End-to-end analyses and the registered query catalog.

``analyses`` (Q1-Q7), ``lookalike`` (inputs derived from the driver tables),
``oracle`` (the same inputs in DuckDB SQL), ``catalog`` (one query per operator,
with its SQL oracle where SQL can express it).
"""
