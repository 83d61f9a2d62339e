from . import readers, schemas, writers

__all__ = ["readers", "schemas", "writers"]
