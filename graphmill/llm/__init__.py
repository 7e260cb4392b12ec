"""Training-data operators (near-dedup, language-model scores, packing, mixing, extraction, ...)."""
