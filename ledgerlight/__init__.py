"""Banking analytics as plain Spark DataFrame operators.

Every operator takes DataFrames (or column names) and returns a DataFrame, so
Catalyst sees one declarative plan.  See ``README.md`` for the map.
"""
