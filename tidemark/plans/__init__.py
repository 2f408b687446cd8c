"""Jobs that write: the history store and the four jobs on top of it."""

from .jobs import DiffReport, RebuildReport, diff, integrate, rebuild, report
from .scratch import scratch_folder
from .store import HistoryStore

__all__ = [
    "DiffReport",
    "HistoryStore",
    "RebuildReport",
    "diff",
    "integrate",
    "rebuild",
    "report",
    "scratch_folder",
]
