"""Distributed operators Spark has no single call for."""
