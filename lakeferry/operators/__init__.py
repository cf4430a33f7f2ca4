"""Loads, merges, exports, inference, conformance, files as data, registries and SQL."""
