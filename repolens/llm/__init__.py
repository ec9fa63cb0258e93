"""Operators for training-data pipelines over text tables.

Each module holds one operator as ``DataFrame -> DataFrame`` functions with the column names as
parameters; ``queries`` registers one query per operator. Nothing outside this folder imports it.
"""
