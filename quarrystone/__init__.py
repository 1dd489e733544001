"""A Spark-first analytics engine for entity evidence and text corpora."""
