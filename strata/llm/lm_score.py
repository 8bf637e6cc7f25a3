"""Cross-entropy difference scores (operator 7; Moore and Lewis 2010).

A document's score is the mean over its tokens of the target model's loss
minus the background's (in nats): the lower, the more like the target.  Every
bigram of real words is counted, in tables that grow with the corpus (``lm_tables``).

Defined results: texts without a token have n_tokens 0, null losses and score
0; without target documents the two models differ by smoothing only; repeated
rows and repeated or null ids give a row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lm_tables

#: Target ids up to this many go to every task; beyond, the flag is joined by a shuffle.
BROADCAST_IDS = 2_000_000


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) by bigram tables of all documents."""
    ids = target_ids.select(F.col("doc_id").alias("target_id")).where(F.col("doc_id").isNotNull()).distinct()
    if ids.count() <= BROADCAST_IDS:
        return lm_tables.scores(docs, F.broadcast(ids))
    return lm_tables.scores(docs, ids, shuffled=True)
