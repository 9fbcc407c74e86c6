"""Listing-price analytics on Spark: clean, model, measure and compare property listings."""
