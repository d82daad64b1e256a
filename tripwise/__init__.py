"""tripwise: trip-duration analytics on Spark DataFrames.

Cleans raw bike and taxi trip records, joins them to daily weather, derives
calendar / peak-hour / chord-distance / location-cluster features, drops speed
outliers, and fits, compares and applies tree, forest and linear regressors.
"""

__version__ = "0.1.0"
