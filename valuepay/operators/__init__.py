"""Operators: aggregate helpers, default-filled joins, exact order statistics."""
