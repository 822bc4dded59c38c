"""Tallystone: lending-ledger analytics as Spark jobs.

Dirty all-text exports from three systems (a CRM, a loan-servicing system and a
fund-accounting ledger) become typed staging tables, versioned dimensions, an
idempotent transaction fact and portfolio reports.
"""
