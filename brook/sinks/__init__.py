"""K1-K4: log, text files, JSON envelopes, raw pass-through."""
