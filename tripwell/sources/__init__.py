"""Readers, writers and the shared folder for stored tables."""
