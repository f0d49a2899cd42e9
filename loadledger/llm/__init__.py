"""Operators of a pipeline for training data; importing the modules fills the registry."""

from loadledger.llm import chat, crosstok, decontam, exact, html, langid, mixing, repeats, secrets, simhash, tokens, trie, warc
from loadledger.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "chat", "crosstok", "decontam", "exact", "html", "langid", "mixing", "repeats", "secrets", "simhash", "tokens", "trie", "warc"]
