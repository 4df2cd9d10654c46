"""Operators are functions from frames to frames; see the modules."""
