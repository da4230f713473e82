"""Column functions (JSON paths, strings, dates) built on Spark SQL built-ins."""
