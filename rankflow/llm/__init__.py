"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage. ``queries`` registers
``opN_<name>`` for every operator and ``pipeline``; ``oracle`` holds the
DuckDB SQL of those that SQL can express.
"""
