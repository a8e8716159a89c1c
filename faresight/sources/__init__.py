"""Sources and sinks: table reading, the option-level binding, stage store."""

from faresight.sources.tables import read_table
from faresight.sources.binding import candidates

__all__ = ["read_table", "candidates"]
