"""Versioned tables and the streams that feed them."""
