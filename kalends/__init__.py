"""kalends: monthly price-index and expenditure-weight analytics on Spark DataFrames."""

__version__ = "0.1.0"
