"""lodestat: statistics, graph, text and stream operators on Spark DataFrames."""

__version__ = "0.1.0"
