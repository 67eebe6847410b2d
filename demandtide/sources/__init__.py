"""Reading versioned tables and file drops; writing contracts, partitions and scenarios."""
