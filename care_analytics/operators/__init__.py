"""Reusable DataFrame operators; each returns a lazy DataFrame or Column."""
