"""Leasing-credit lifecycle analytics as PySpark DataFrame operators."""
