"""Marquee: recommendation and engagement analytics as Spark DataFrame jobs."""
