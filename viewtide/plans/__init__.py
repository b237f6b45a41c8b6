"""The jobs: star schema, analyses, ingest, page parsing and status updates."""
