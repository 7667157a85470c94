"""ledgerline — load, stage, report on and check e-commerce order data with Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
native Spark expressions, so one Catalyst plan spans load, staging and report.

Sub-packages:

* ``sources``   – CSV scan with pandas-compatible NA tokens, test-data views.
* ``functions`` – scalar / aggregate helpers (rounding, percentages, months,
                  distributed rank and exact median).
* ``operators`` – cleaning, validation, incremental load, staging, reports and
                  data-quality checks.
* ``plans``     – compositions: the mart DAG, the end-to-end load pipeline,
                  the registry of named queries and their SQL oracles.
* ``streaming`` – the incremental loader driven by Structured Streaming.
"""

from ledgerline.session import build_session, scratch_path  # noqa: F401

__all__ = ["build_session", "scratch_path"]
