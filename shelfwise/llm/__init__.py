"""Training-data operators: quality, deduplication, scanning, decontamination and tokenizing."""
