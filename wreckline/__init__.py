"""wreckline — crash / unit / person record analytics as plain Spark DataFrame functions.

Layout:
  sources/    readers, CSV ingest with quarantine, Parquet / catalog sinks, test-table mapping
  functions/  Column builders (calendar, text clean-up, slot value expressions)
  operators/  DataFrame -> DataFrame operators (numbering, slots, summaries, look-ups)
  plans/      end-to-end pipelines composed from operators
  streaming/  incremental landing of CSV drops (file source, available-now trigger)

Every operator that reproduces a known defect of the studied pipeline takes
``compat``: ``True`` reproduces the literal behaviour, ``False`` the evident intent.
"""

from wreckline.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
