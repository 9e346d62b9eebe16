"""Queries by theme; importing this package enters them into the registry."""

from glossmark.plans import inventories, jobs, market, note_jobs, passages, records, reports, search, sync, themes  # noqa: F401
