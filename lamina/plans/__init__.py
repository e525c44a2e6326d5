"""Queries: the operators on the driver's tables, with the SQL that says the same."""

from . import genomes, joins, matrices, sequences
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "genomes", "joins", "matrices", "sequences"]
