"""Structured Streaming forms: watermarks, keyed state, windowed summaries."""
