"""Structural clustering analytics on Spark."""
