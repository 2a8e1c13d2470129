"""Spark-native analytics over campaign-finance style data: sources, scalar
functions, relational operators, gold plans, streaming and a query surface."""

__version__ = "0.1.0"
