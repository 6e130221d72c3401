"""Customer analytics as PySpark ``DataFrame -> DataFrame`` functions."""
