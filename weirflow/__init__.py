"""Streaming ingestion, change capture, windowed statistics and schema drift on PySpark."""
