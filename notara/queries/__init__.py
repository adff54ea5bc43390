"""All queries of the note engine: import registers them."""

from . import catalogs, entities, files, links, stages, texts  # noqa: F401
from ._base import ORACLES, QUERIES  # noqa: F401
