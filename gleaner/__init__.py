"""Document-stream curation on Spark DataFrames."""

from gleaner.session import get_session

__all__ = ["get_session"]
