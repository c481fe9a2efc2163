"""Data governance for lake tables as ordinary Spark jobs."""

from lakewarden.session import build_session, checkpoint

__all__ = ["build_session", "checkpoint"]
