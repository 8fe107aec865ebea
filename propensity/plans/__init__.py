"""Registered queries, oracles, flows and checks."""
