"""Readers: JSON lines, queue envelopes, asset listings, state."""
