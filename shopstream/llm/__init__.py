"""Training-data operators: secrets, quality, WARC, dedup, decontamination, toxicity, packing."""
