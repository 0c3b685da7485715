"""Streaming reads of newly arrived files; the stages themselves are row-wise and work on either kind of frame."""
