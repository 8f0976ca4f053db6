"""Operators: load, metrics, comparison, text parity, audits, views, evidence."""
