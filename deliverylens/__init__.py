"""Delivery analytics over software-delivery tables, expressed as Spark DataFrames."""
