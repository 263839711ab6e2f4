"""Registered queries, each with its SQL twin, by topic."""

from __future__ import annotations

from importlib import import_module

TOPICS = ["words", "reports", "cells", "posts", "ranking", "geo", "logs", "merges", "joins"]


def all_queries() -> dict:
    return {name: q for topic in TOPICS for name, q in _topic(topic).QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for topic in TOPICS for name, sql in _topic(topic).ORACLES.items()}


def _topic(name: str):
    return import_module(f"tallyloom.plans.{name}")
