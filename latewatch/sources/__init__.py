from latewatch.sources import catalog, readers, writers

__all__ = ["catalog", "readers", "writers"]
