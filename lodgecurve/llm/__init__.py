"""Operators for preparing large text corpora as training data, each a DataFrame -> DataFrame job."""
