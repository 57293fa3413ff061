"""Readers, writers and the domain tables."""
