"""Composed study plans, registered queries and their SQL oracles."""
