"""From a spec to one lazy DataFrame, and to its target."""

from tableflow.plans.flow import build, run
from tableflow.plans.shape import assemble, derive, duplicate_names

__all__ = ["assemble", "build", "derive", "duplicate_names", "run"]
