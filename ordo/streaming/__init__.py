"""Structured Streaming: incoming text files -> sorted runs + rejects."""

from ordo.streaming.runs import stream_sorted_runs

__all__ = ["stream_sorted_runs"]
