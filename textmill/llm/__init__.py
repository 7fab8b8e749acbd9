"""Operators of a training-data pipeline: filtering, deduplication,
decontamination, search, packing and bookkeeping over the text tables."""
