"""Retail-basket analytics as Spark DataFrame jobs: clean, marts, quality gate, publish."""
