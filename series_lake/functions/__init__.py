"""Column-to-column building blocks; all of them Spark built-ins."""
