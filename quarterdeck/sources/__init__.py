"""Reading the inputs and keeping the stored tables."""
