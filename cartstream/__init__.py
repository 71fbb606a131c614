"""Storefront event analytics as Spark jobs."""
