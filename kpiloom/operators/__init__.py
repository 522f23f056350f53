"""Staging, mart and data-quality operators (DataFrame → DataFrame)."""
