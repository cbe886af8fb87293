"""Incremental ingestion and analysis of institutional records with Spark DataFrames."""
