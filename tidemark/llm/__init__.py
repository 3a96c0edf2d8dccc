"""Training-data operators: deduplication, extraction, search, mixing, archives, chat, toxicity, tokens."""
