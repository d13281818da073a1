"""Named queries over the driver's tables, each with its SQL twin."""

from __future__ import annotations

from . import images, kernels, relations, stores, texts

QUERIES = {**images.QUERIES, **relations.QUERIES, **texts.QUERIES, **kernels.QUERIES, **stores.QUERIES}
ORACLE_SQL = {**images.ORACLE_SQL, **relations.ORACLE_SQL, **texts.ORACLE_SQL, **stores.ORACLE_SQL}
