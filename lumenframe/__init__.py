"""Multimodal feature analytics on Spark DataFrames."""
