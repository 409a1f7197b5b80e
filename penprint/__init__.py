"""penprint: corpus stylometry and authorship attribution as Spark jobs.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is collected unless its size is bounded by a setting.
"""

from penprint.settings import Settings

__all__ = ["Settings"]
