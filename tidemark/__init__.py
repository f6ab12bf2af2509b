"""Keyed event streams on Spark: decode, validate, keep the latest row per key,
join, and maintain grouped counts and averages, in batch and in streaming."""
