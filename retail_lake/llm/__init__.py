"""Training-data operators; each module holds one operator and documents its edge cases."""
