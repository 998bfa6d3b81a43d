"""Part of siltwork."""
