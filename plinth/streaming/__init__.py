"""The same operators run as Structured Streaming micro-batches."""
