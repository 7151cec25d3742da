"""The jobs: ingestion, Silver, Gold, geometry, timetable, feed profile, stations, checks."""
