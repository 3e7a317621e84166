"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this package imports it.  Operators take a DataFrame and column
names and return DataFrames; ``queries`` holds the thin registered forms.
"""
