"""Imports every query module of this subpackage, so that its registry is complete."""

from trackflow.llm import q_chat, q_minhash, q_near, q_pages, q_quality, q_repeats, q_resample, q_spelling, q_tokens, q_urls, q_vectors  # noqa: F401
from trackflow.llm.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
