"""Operators put together: the pipelines and the daily reports."""
