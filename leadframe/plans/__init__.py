"""Registered queries; importing the modules fills the registry."""

from . import crm_queries, page_queries, text_queries, title_queries  # noqa: F401
from . import io_queries, web_queries  # noqa: F401
from .registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
