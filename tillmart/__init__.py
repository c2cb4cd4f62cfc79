"""Retail analytics on PySpark: raw sales files to star schema, marts and reports."""
