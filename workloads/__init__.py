"""The registered queries: each builds its input from the given tables and runs one capability.

Every module has ``QUERIES`` (key -> callable) and ``ORACLES`` (key -> SQL for the same result).
"""
