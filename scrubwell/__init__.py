"""Corpus cleaning and redaction as Spark DataFrame jobs."""
