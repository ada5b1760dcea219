"""Imports every module that registers queries."""

from suite import (  # noqa: F401
    benchmark_queries,
    control_queries,
    fitting_queries,
    incidence_queries,
    lake_queries,
    publish_queries,
    quality_queries,
    report_queries,
    seed_queries,
    summary_queries,
    synthesis_queries,
)
