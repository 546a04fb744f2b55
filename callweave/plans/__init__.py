"""Whole runs: configuration, the engine and the sink."""
