"""All registered queries."""

from checks import cases_q, models_q, records_q, sources_q, streams_q  # noqa: F401
from checks.base import QUERIES, SQL  # noqa: F401
