"""Millrace: corpus curation as Spark DataFrame plans."""
