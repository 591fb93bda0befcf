"""lakemart: raw activity logs + catalogue -> clean star schema and lookup tables, on Spark."""

__version__ = "0.1.0"
