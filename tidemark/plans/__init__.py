"""Whole reports and the layered run."""
