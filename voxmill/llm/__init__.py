"""Training-data operators (packing, fingerprints, near-dedup, language, toxicity, decontamination, extraction, PII, secrets)."""
