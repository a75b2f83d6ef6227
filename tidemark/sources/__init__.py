"""Readers, writers and keyed snapshots."""
