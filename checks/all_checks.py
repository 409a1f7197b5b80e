"""Importing this module registers every query."""

from checks import corpus, evaluation, features, files, structure, sweeps, text  # noqa: F401
