"""Marketplace order analytics expressed as Spark DataFrame operators."""
