"""Retail event analytics on PySpark: logs and change events in, daily reports out.

Every operator is a function from DataFrame to DataFrame.  The same functions
serve batch tables and, unless they say otherwise, Structured Streaming.
"""

from martflow.session import build_session, tune

__all__ = ["build_session", "tune"]
