"""Structured Streaming entry points (micro-batch scoring with a fitted plan)."""

from .score import ScoringPlan, score_stream

__all__ = ["ScoringPlan", "score_stream"]
