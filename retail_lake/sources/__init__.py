"""Inputs (seed CSV files, driver fixture tables) and table sinks."""
