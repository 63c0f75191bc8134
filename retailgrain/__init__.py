"""Retail analytics operators and reports as lazy PySpark DataFrame transformations."""

from retailgrain.session import build_session, shared_dir, tune

__all__ = ["build_session", "shared_dir", "tune"]
