"""Training-data operators: scoring, archives, de-duplication, scans and packing of text corpora."""
