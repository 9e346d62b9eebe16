"""Spark-first analytics over dated text corpora and daily price series."""
