"""Restartable, idempotent table ingestion on Spark DataFrames, with a run ledger kept as a table."""

from loadledger.plans.extract import Extractor, Outcome
from loadledger.plans.spec import TableSpec
from loadledger.sinks.ledger import Ledger
from loadledger.sources.jdbc import JdbcSource
from loadledger.sources.lake import LakeSource

__all__ = ["Extractor", "JdbcSource", "LakeSource", "Ledger", "Outcome", "TableSpec"]
