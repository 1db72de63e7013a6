"""Retail sales analytics and forecasting on Spark DataFrames and Spark ML."""
