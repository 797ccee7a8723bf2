"""Table operators: functions from DataFrames and parameters to one lazy DataFrame."""
