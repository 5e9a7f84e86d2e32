from . import audit, ordered

__all__ = ["audit", "ordered"]
