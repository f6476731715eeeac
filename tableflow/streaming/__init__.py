"""File streams into files and cell stores."""

from tableflow.streaming.sinks import write_stream

__all__ = ["write_stream"]
