"""DataFrame transforms that work alike in batch and inside a micro-batch."""
