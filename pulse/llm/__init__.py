"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; ``queries`` lists what it
registers. Every operator is a ``DataFrame -> DataFrame`` function.
"""
