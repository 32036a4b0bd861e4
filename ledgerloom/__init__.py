"""Distributed feature engineering for company fundamentals, as PySpark DataFrame operators."""
