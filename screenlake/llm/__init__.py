"""Training-data operators: URL rules, HTML extraction, secrets, packing, toxicity, fingerprints, suffix deduplication, chat
formatting, Jaccard join, benchmark decontamination, token counts, conversation repair and whitening."""
