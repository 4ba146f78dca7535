"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from ..operators.scratch import Scratch, columns, fresh, shared_dir

__all__ = ["Scratch", "columns", "fresh", "shared_dir"]
