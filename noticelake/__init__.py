"""Notice monitoring on Spark: landing, cleaning, table upkeep and reports."""

from noticelake.session import build_session

__all__ = ["build_session"]
