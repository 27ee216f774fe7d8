"""All registered queries."""

from tallymark.plans import (  # noqa: F401 - importing registers them
    queries_catalog,
    queries_curation,
    queries_reconcile,
    queries_records,
    queries_rollup,
    queries_sources,
    queries_streaming,
)
from tallymark.plans.driver import ORACLES, QUERIES  # noqa: F401
