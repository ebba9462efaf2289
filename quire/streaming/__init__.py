"""Stateless checks of page records that arrive as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions import text as T
from quire.operators.checks import violation
from quire.spec import LayoutSpec


def watch(pages: DataFrame, spec: LayoutSpec, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands the violations of each batch of page records (edition_id, page, lines) to ``sink``."""
    n = F.size("lines")
    numbers = F.transform("lines", lambda x: x["line"])
    bad = violation(pages.filter((n < 1) | (n > spec.max_lines) | (numbers != F.sequence(F.lit(1), F.greatest(n, F.lit(1))))), "page_lines", T.key("edition_id", "page"), n)
    return bad.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).start()
