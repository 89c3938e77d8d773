"""Readers of landed extracts, the lake's versioned tables and its catalog."""
