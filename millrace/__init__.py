"""millrace: crawl-frontier and work-queue analytics on Spark DataFrames."""

__version__ = "0.1.0"
