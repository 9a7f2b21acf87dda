"""Intermediate tables in the folder that all executors share (see ``verisift.sources.folders``)."""

from verisift.sources.folders import forget, new_path, remove, shared_dir, stored

__all__ = ["forget", "new_path", "remove", "shared_dir", "stored"]
