"""Whole jobs: models, the model grid, the workflow, scoring."""
