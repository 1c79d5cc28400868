"""The registered queries and the SQL they are checked against."""

from marquee.plans import cleaning, feeds, modelling, selection, transport  # noqa: F401
from marquee.plans.registry import ORACLES, QUERIES  # noqa: F401
