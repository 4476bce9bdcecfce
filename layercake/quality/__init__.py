"""Declared data tests: rules as data, checked in as few passes as possible."""

from layercake.quality.checks import Rule, check

__all__ = ["Rule", "check"]
