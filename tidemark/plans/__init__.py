"""Whole-layer plans put together from operators."""
