"""Interval, read-pair and corpus analytics as Spark DataFrame plans."""
