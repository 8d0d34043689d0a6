"""Moving tables with Spark: split reads, conformed columns, published tables.

Every operator is a plain function over DataFrames; Catalyst plans the work.
"""

__version__ = "0.1.0"
