"""The periodic jobs on streams: the same columns, kept up to date."""
