"""Column functions, and the small Python helpers that read prose and HTML."""
