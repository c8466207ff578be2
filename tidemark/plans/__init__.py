"""What a load reads: column ranges, stride plans, and the loader itself."""
