"""Event analytics on PySpark: batch definitions and their streaming forms."""
