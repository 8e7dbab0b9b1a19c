"""Every query of the library by name, and the SQL that gives the same rows."""

from . import caption_queries, gate_queries, grid_queries, report_queries, source_queries, star_queries, stream_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
