"""Registers the query of every operator of this package; a list of imports and nothing more."""

from __future__ import annotations

from profilespark.llm import exact_dedup, fill_in_middle, filter_audit, fingerprints, language_id, licenses, line_dedup, mixing, near_dedup, packing, quality_rules, token_counts, warc  # noqa: F401
from profilespark.llm.common import ORACLES, QUERIES  # noqa: F401
