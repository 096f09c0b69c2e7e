"""Cleaning, features, splits, metrics and models as DataFrame functions."""
