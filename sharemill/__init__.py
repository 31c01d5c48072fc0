"""Weekly audience-share analytics as plain PySpark DataFrame transformations."""

from sharemill.asof import AsOf
from sharemill.rules import DEFAULT_RULES, RollUp, Rules
from sharemill.settings import CleanSettings, MartSettings

__all__ = ["AsOf", "CleanSettings", "DEFAULT_RULES", "MartSettings", "RollUp", "Rules"]
