"""All registered queries."""

from quizloom.checks.file_queries import FILE_QUERIES
from quizloom.checks.queries import QUERIES as TABLE_QUERIES

QUERIES = {**TABLE_QUERIES, **FILE_QUERIES}
