from .incremental import ingest_new_trip_files, new_trip_files  # noqa: F401
