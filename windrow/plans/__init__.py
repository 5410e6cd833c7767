"""The analyses, put together from operators; each takes a batch table or a stream."""
