"""Inputs and stored topics."""
