"""Readers and writers."""

from tabwright.sources.loading import load, load_clean, preview, reload, require_non_empty

__all__ = ["load", "load_clean", "preview", "reload", "require_non_empty"]
