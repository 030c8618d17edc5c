"""Training-data operators: dedup, extraction, scans, scoring, mixing, archives."""
