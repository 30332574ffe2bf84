"""Retail order analytics expressed as Spark DataFrame jobs."""
