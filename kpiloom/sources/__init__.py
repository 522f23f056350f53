"""Source readers, the fixed source schemas, and the mart sink."""

from kpiloom.sources.io import read_source, read_sources, register, write_mart
from kpiloom.sources.schemas import SOURCE_NAMES, SOURCE_SCHEMAS

__all__ = ["read_source", "read_sources", "register", "write_mart", "SOURCE_NAMES",
           "SOURCE_SCHEMAS"]
