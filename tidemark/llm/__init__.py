"""Operators of a training-data pipeline, on Spark DataFrames.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing else in the library imports this subpackage.
"""
