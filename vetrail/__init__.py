"""Supplier-risk analytics as PySpark DataFrame operators."""
