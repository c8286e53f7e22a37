"""Structured Streaming."""

from tessera.streaming.incremental import dedupe_run, incremental_run

__all__ = ["dedupe_run", "incremental_run"]
