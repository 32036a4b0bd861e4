"""End-to-end flows: ingest, statement join, features."""
