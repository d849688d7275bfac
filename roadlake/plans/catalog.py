"""Imports every query module, so that the registry is complete."""

from roadlake.plans import decoding, drives, driving, exploring, handling, signals, streams  # noqa: F401
from roadlake.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
