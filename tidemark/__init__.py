"""Incremental star-schema loads on PySpark."""

from tidemark.operators import ConstraintError
from tidemark.plans.courses import COURSES
from tidemark.plans.extract import extract
from tidemark.plans.pipeline import LoadResult, load, run
from tidemark.plans.warehouse import Warehouse
from tidemark.session import build_session
from tidemark.sources import FrameSource, JdbcSource, ParquetSource

__all__ = [
    "COURSES",
    "ConstraintError",
    "FrameSource",
    "JdbcSource",
    "LoadResult",
    "ParquetSource",
    "Warehouse",
    "build_session",
    "extract",
    "load",
    "run",
]
