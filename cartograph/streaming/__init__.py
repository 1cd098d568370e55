"""Streaming form of the daily roll-up (the reference itself is batch only)."""
