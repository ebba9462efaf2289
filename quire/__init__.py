"""Alignment, roll-up and validation of ordered text streams on Spark."""
