"""Federated learning analytics over sensor streams, as Spark DataFrame functions."""
