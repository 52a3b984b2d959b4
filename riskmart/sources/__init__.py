"""Readers, writers, the log of raw files and scratch tables."""
