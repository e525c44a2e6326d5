"""Spark-first analytics for sample-by-feature studies: sources, operators, functions, plans and streaming."""
