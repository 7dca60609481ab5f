"""The jobs as functions from DataFrames to DataFrames; reading and writing happens elsewhere."""
