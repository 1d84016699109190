"""Deliberately empty: the feature set is batch only (reference dates, not watermarks)."""
