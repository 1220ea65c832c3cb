"""Operators on flow tables: DataFrame in, DataFrame out."""
