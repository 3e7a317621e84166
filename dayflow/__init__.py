"""dayflow: daily-flow analytics and forecasting as Spark DataFrame operators.

Every public operator takes DataFrames (plus column names / parameters) and
returns a DataFrame.  Nothing is collected to the driver; key columns are
arguments so one global series and a keyed panel of many series share code.
"""

__version__ = "0.1.0"
