"""Operators for preparing training data, each by a stated method.

Modules take and return DataFrames and know nothing of the tables they are
applied to in ``atelier.llm.queries``.
"""
