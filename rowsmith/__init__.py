"""rowsmith: data preparation and tabular learning as Spark DataFrame operators."""

from rowsmith.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
