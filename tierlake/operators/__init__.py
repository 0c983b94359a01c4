"""Upsert, publish, id mapping and gold views."""
