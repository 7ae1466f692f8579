"""Predictors built in this Python worker, by the key of their scoring call."""

LOADED: dict[str, object] = {}
