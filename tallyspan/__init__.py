"""Longitudinal features, risk scoring and drift on Spark."""
