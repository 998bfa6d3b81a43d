"""Operators for preparing training text; nothing else in siltwork imports this subpackage."""
