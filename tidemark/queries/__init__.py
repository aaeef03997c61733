"""Queries over the given tables, one per operator, each with the SQL that must give the same rows."""

from . import core, evaluation, files, more, net, onto, text
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "core", "evaluation", "files", "more", "net", "onto", "text"]
