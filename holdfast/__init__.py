"""Retention analytics as Spark DataFrame operators."""
