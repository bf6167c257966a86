"""Family-aware variant analytics as PySpark DataFrame operators."""
