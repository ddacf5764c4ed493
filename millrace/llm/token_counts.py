"""Token counts with a shortcut for pre-tokens that are one token.

The driver proves once which vocabulary strings encode alone as a single token. Tasks count
pre-tokens found among them directly and run merges only for the rest. What was merged is kept
per worker, up to a bound.

NULL and empty texts have 0 tokens and 0 bytes. Rows are independent: repeated rows, NULL ids
and empty tables need no rule. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import bounded_batches, kept_in_worker, utf8
from .pieces import Pieces, Recent, load_config, share, whole_tokens


def piece_counts(config: str, whole: frozenset[str]) -> tuple[Pieces, Recent]:
    """The cutter, and tokens per pre-token: one if it is a whole token, else those of its merges."""

    def make():
        pieces = Pieces(config)
        return pieces, Recent(lambda piece: 1 if piece in whole else len(pieces.merge(piece)))

    return kept_in_worker(("token counts", hash(config)), make)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    ``tokenizer`` is the path of a tokenizer file, read on the driver only.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    config = load_config(tokenizer)
    shared = share(spark, (config, whole_tokens(config)))

    @arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        config, whole = shared.value
        pieces, counts = piece_counts(config, whole)
        if pieces.known:
            count = counts.__getitem__
            for texts in batches:
                yield pa.array([sum(pieces.spread(t, count, len)) for t in utf8(texts)], pa.int64())
        else:
            for texts in batches:
                yield pa.array([len(pieces.encode(t.decode())) for t in utf8(texts)], pa.int64())

    return docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "n_tokens": tokens(F.col(text)),
        }
    ).withColumn("over_limit", F.col("n_tokens") > limit)
