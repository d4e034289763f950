"""Operators of training-data preparation: text forms, names, scanned pages, transcripts, packing, leaks, spans."""
