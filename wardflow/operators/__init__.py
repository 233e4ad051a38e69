"""Operators: DataFrames and parameters in, one lazy DataFrame out. None reads a clock."""
