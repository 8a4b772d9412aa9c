"""Structured Streaming drivers for incremental releases."""

from proficio.streaming.releases import merge_releases, newest_release

__all__ = ["merge_releases", "newest_release"]
