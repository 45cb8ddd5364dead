"""Registered queries and their SQL forms."""
