"""Segmentation, recommendation and forecasting on Spark MLlib."""
