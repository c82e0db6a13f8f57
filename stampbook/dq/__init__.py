"""Data-quality checks, their roll-up and their reporting series."""
