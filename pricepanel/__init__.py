"""Average price panels from monthly price quotes, as Spark DataFrame jobs."""

from pricepanel.plans.history import History, build_history
from pricepanel.plans.rollforward import RollForward, roll_forward
from pricepanel.schema import HISTORY_PERIODS, ROLL_FORWARD_PERIOD, Period
from pricepanel.sources.panels import read_audit, read_panel, write_audit, write_panel
from pricepanel.sources.published import publish_panel, read_published
from pricepanel.sources.quotes import read_quotes

__all__ = [
    "HISTORY_PERIODS",
    "ROLL_FORWARD_PERIOD",
    "History",
    "Period",
    "RollForward",
    "build_history",
    "publish_panel",
    "read_audit",
    "read_panel",
    "read_published",
    "read_quotes",
    "roll_forward",
    "write_audit",
    "write_panel",
]
