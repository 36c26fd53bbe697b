"""Structured Streaming forms of grid operators: an extension, the batch operators are the reference."""
