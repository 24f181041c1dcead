"""Readers, raw schemas and the mapping of the sample tables onto them."""
