"""Operators of a training-data pipeline. Nothing outside this folder imports it but ``__spark_entry__``."""


def load_all() -> dict:
    """Import every operator module; each registers its query."""
    from . import (  # noqa: F401
        decontaminate, fingerprints, hard_negatives, language_id, licenses, line_dedup, lm_score, mixing, periodic_runs,
        quality, simhash, suffix_dedup, warc)
    from .common import QUERIES
    return QUERIES
