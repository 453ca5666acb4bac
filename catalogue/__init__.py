"""Registered queries and their SQL oracles over the shared test tables."""
