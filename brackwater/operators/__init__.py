"""DataFrame operators: functions of DataFrames to DataFrames."""
