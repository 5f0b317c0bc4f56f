"""Spark-first engine that turns crawled web pages into scored, chunked, searchable text."""
