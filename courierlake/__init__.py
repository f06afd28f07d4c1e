"""Delivery-feed data engine on Spark."""
