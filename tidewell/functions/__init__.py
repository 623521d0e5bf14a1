"""Column expressions: lenient casts and big-endian blobs, all native."""
