"""Spark-native analytics operators for key-value, wide-column, post and log data."""

from tallyloom.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
