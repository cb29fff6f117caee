"""Scalar column helpers shared by marts and cards."""
