"""Registra: register-style open data on Spark, from raw extracts to marts."""

__version__ = "0.1.0"
