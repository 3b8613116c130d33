"""Tabular analytics and learning operators as PySpark DataFrame plans."""
