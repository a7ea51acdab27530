"""Operators over sightings, each a function from DataFrames to a DataFrame."""
