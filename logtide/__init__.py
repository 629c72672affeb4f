"""Log traffic, stream position and recommendation jobs on Spark DataFrames."""

__version__ = "0.1.0"
