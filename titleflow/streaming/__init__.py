"""The stateless title operators applied to streaming DataFrames."""
