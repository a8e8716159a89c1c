"""Column-expression builders.  Everything here returns ``Column`` objects
that stay inside whole-stage codegen; no Python UDFs."""

from faresight.functions.scalar import *  # noqa: F401,F403
from faresight.functions.aggregates import *  # noqa: F401,F403
