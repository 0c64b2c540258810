"""Hourly environmental readings on PySpark: flatten, clean, enrich, combine, roll up, audit."""
