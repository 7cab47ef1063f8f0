"""tidemark: layered (bronze/silver/gold) warehouses with history, on Spark DataFrames."""

from tidemark.session import build_session, configure

__version__ = "0.1.0"
__all__ = ["build_session", "configure"]
