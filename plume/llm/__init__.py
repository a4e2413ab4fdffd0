"""Operators of a training-data pipeline over document tables.

Every operator takes DataFrames and returns DataFrames, keeps its own general
interface, and selects only the columns it needs, so extra input columns
(whatever their names) never clash with its own.  ``queries`` holds the thin
registered ``opN_<name>`` queries.  Nothing else in the library imports this
subpackage.
"""
