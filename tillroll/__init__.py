"""Retail-loyalty batch pipeline on Spark DataFrames: stage, build, load."""
