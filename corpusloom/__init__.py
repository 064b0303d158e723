"""A PySpark-first engine for preparing large text corpora."""
