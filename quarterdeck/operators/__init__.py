"""DataFrame -> DataFrame operators on the panel and on dated events."""
