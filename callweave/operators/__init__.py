"""Operators over event and rule tables."""
