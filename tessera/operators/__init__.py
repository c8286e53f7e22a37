"""DataFrame -> DataFrame operators (clean, dedupe, validate, transform, search,
metrics, chunking, JSON flattening, HTML extraction)."""
