"""Readers, writers, the test fixture and small reference tables."""
