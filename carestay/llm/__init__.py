"""Training-data operators: toxicity, fingerprints, extraction, dedup, scans, quality, decontamination, BPE."""
