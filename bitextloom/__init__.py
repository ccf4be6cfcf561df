"""A PySpark library that prepares parallel text corpora."""
