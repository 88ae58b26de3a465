"""Event-stream enrichment and analytics as plain PySpark DataFrame operators."""

from tidegrid.config import Settings
from tidegrid.session import build_session, use_utc, work_dir

__all__ = ["Settings", "build_session", "use_utc", "work_dir"]
