"""Layered batch-table operators written as PySpark DataFrame plans."""
