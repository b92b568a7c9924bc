"""Retail lakehouse analytics on PySpark: batch models, live windows, checks."""

from martloom.session import build_session, configure

__all__ = ["build_session", "configure"]
