"""Readers that turn landed files and documents into DataFrames."""
