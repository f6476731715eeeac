"""Declarative table pipelines on Spark: sources, one join, filter, derived columns, one sink."""

from tableflow.plans import build, run
from tableflow.plugins import register
from tableflow.session import start_session
from tableflow.spec import PipelineSpec, SourceSpec, TargetSpec

__all__ = ["PipelineSpec", "SourceSpec", "TargetSpec", "build", "register", "run", "start_session"]
