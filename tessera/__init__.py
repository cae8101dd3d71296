"""tessera: batch text, table and graph analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame. Nothing here
collects to the driver or changes session settings; Catalyst and AQE pick the
physical plan.
"""

__version__ = "0.1.0"
