"""Incremental intake of arriving stock files (the only appended data)."""
