"""Structured Streaming forms: runners, running counts, the first-seen dictionary."""
