"""Payload scans: landed feed/API bodies -> typed record rows with an ordinal."""
