"""atelier: a Spark-native build of a craft-marketplace customer reporting mart.

Layers
------
- ``atelier.functions``  column expressions (month key, day difference,
  status flags, assignment rounding).
- ``atelier.sources``    readers, the fixture mapping from the driver tables,
  and the versioned table protocol (write a version, then commit it).
- ``atelier.operators``  DataFrame -> DataFrame operators: source
  consolidation, surrogate keys, merge/upsert, delta detection, measures,
  ranking, quality checks and diagnostics.
- ``atelier.plans``      the user-level jobs: load the star schema, build the
  mart (literal and intended forms), full and incremental refresh.
"""

from atelier.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
