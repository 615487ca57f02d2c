"""Whole jobs: the stored warehouse and the end-to-end pipeline."""
