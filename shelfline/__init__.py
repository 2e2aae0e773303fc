"""Shelfline: a retail analytics pipeline expressed in Spark DataFrames."""

from shelfline.lakehouse import Lakehouse
from shelfline.session import build_session

__all__ = ["Lakehouse", "build_session"]
