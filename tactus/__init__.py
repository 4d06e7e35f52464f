"""Tactus: musical time, note events and audio features as Spark DataFrames."""
