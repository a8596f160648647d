"""Lodeworks: a governed lakehouse for multi-system industrial data, built on Spark."""
