"""Panel operators: functions from DataFrames to DataFrames."""
