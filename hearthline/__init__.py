"""Listings lifecycle analytics as Spark DataFrame jobs."""
