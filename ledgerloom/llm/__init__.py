"""Training-data operators: deduplication, search, labelling, tokenising and mixing as Spark jobs."""
