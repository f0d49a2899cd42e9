"""All registered queries; importing the modules fills the registry."""

from loadledger.catalog import columns, extracts, intervals, progress, quality, states, streams
from loadledger.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "columns", "extracts", "intervals", "progress", "quality", "states", "streams"]
