"""Incremental landing of new filings: the streaming form of collecting by date slice and
skipping what is already there."""

from kessan.streaming.landing import land_new_fact_files  # noqa: F401
