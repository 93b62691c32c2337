"""Log and trace analytics as PySpark DataFrame operations."""

from emberlog.logtable import LogTable
from emberlog.session import get_session

__all__ = ["LogTable", "get_session"]
