"""Incremental processing of new ledger files."""
