"""Facts, rollups, marts and reports built from the operators."""
