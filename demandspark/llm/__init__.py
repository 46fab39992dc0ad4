"""Operators of a training-data pipeline: filtering, deduplication, sharding and packing of documents."""
