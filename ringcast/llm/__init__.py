"""Operators for training-data pipelines over the tables of documents and pages."""
