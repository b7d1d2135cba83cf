"""strata: batch and speed views over forum activity, built on Spark DataFrames."""

from .session import build_session, checkpoint_root, ensure_utc, scratch_path

__all__ = ["build_session", "checkpoint_root", "ensure_utc", "scratch_path"]
