"""Sensor analytics on Spark: land, clean, roll up, score, watch."""
