"""Publish business metrics without exposing names: masking, metrics and claim checks on Spark."""
