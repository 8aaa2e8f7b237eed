"""Spark-first analytics over document-derived entity histories."""
