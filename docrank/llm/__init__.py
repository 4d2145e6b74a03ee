"""Operators of a training-data pipeline: packing, language ID, benchmark
decontamination, quality scoring, near-copy joins, repeated-substring removal,
exact vector search, license scans, host reputation and toxicity."""
