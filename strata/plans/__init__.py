"""Declarations of a dataset and the daily run that follows them."""
