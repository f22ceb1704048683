"""Spark-native stream metrics: strict line parsing, enrichment, windowed and running medal counts."""
