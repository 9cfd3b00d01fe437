"""All registered queries in one place."""

from __future__ import annotations

from suite import alerts, detection, ingest, reports, streams

ALL = {
    **detection.QUERIES,
    **alerts.QUERIES,
    **reports.QUERIES,
    **ingest.QUERIES,
    **streams.QUERIES,
}
