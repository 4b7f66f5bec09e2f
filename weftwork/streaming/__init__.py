"""Micro-batch jobs: transform, load, alerts, and running counts."""
