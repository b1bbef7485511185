"""DataFrame -> DataFrame operators (batch and streaming unless marked)."""
