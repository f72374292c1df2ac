"""Registered queries; each module has QUERIES and SQL."""

MODULES = ["documents", "positions", "responses", "problems", "checks", "wholes"]
