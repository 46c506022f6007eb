"""Country-level macro-economic data on Spark DataFrames.

``functions``  column expressions (percent rules, bands, parsing, formatting)
``sources``    feeds and tables as DataFrames
``operators``  cleaning, reshaping, joins, views, statistics, checks, writers
``plans``      whole jobs and the query registry
"""

__version__ = "0.1.0"
