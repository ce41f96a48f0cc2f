"""Scans of annotation files into DataFrames."""
