"""Queries over the test tables, by family, each with its SQL where SQL can say it."""

from importlib import import_module

FAMILIES = ("problems", "shaping", "texts", "joining", "totals", "windowing", "ranking", "sets", "patching", "patches", "graphs", "inference", "numeric", "functional", "evidence", "upkeep", "notes")


def modules() -> list:
    return [import_module(f"{__name__}.{family}") for family in FAMILIES]
