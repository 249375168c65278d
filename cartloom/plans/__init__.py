"""Logical plans: document fixtures, day pipelines, the query registry."""
