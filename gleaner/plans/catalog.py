"""All registered queries."""

from gleaner.plans import curation_queries, dedupe_queries, edition_queries, source_queries, text_queries  # noqa: F401
