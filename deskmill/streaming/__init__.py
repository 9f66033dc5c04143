"""Structured Streaming jobs, always bounded by an availableNow trigger."""
