"""Structured Streaming entry point: answer a stream of questions."""

from .questions import answer_stream

__all__ = ["answer_stream"]
