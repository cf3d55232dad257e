"""The streaming path: clean, de-duplicate, score and store."""
