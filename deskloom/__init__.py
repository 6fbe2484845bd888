"""Support-ticket analytics on Spark: landed JSON pages in, base tables and views out."""

from deskloom.session import configure

__all__ = ["configure"]
