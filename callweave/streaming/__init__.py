"""Call traces, in batch and as a stream."""
