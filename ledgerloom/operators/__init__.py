"""Table transforms: functions from DataFrames to a DataFrame."""
