"""Named queries over the tables of a folder."""

from loam.plans import audits, conversations, documents, evaluation, extras, pages, reports
from loam.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "audits", "conversations", "documents", "evaluation", "extras", "pages", "reports"]
