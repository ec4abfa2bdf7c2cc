"""Delivery-operations analytics on Spark DataFrames."""

from dispatchlens.settings import Settings

__all__ = ["Settings"]
