"""DataFrame operators.  Each takes DataFrames and column names and returns a
DataFrame; none names a table or collects data to the driver."""
