"""Structured Streaming entry points over the same plans as the batch queries."""
