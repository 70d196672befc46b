"""Evaluate sensor observations against norm bands and rules on Spark."""
