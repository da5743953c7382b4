"""Relational and per-row operators."""
