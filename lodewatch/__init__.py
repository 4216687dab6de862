"""Data observability on Spark: profiles, lineage, observation tables."""

from lodewatch.session import local_session, work_dir

__all__ = ["local_session", "work_dir"]
