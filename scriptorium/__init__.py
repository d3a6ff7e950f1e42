"""Medallion text-corpus pipeline expressed as Spark DataFrame transformations."""
