"""Operators of a training-data pipeline: fingerprints, filters, joins, mixing, packing, archives."""
