"""Retail star-schema loads on PySpark."""
