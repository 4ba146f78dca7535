"""Connected components of a link table by alternating large-star and small-star rounds."""

from ..operators.components import connected_components

__all__ = ["connected_components"]
