"""A next-word model laid out for repeated use: tables in buckets of their join key, so that using them shuffles nothing.

Writing shuffles each table once. Every later model, ranking or lookup over the same counts then joins bucket by bucket and merges
sorted files. One task reads a bucket, and no execution-time splitting applies to it; so a hot pair is split beforehand: if both
its words are hot, its rows are spread over ``SALTS`` buckets by their first word, and the pair table holds it once per salt.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigram.operators.counts import bigram_totals, pair_roles, unigram_totals
from lexigram.operators.next_word import pair_context, score, with_first_pair
from lexigram.operators.sightings import gram_words, grams_and_context, hot_words
from lexigram.session import scratch_dir, stored

SALTS = 4
BUCKETS = 32
KEY = ["w2", "w3", "salt"]


@dataclass
class Layout:
    """Names of the tables: trigrams with the totals of their first pair, pairs with their totals."""

    trigrams: str
    pairs: str

    def stats(self, spark: SparkSession) -> DataFrame:
        """``(w1, w2, w3, n, c12, c23, c2, c3)`` as ``trigram_stats`` gives it."""
        rows = spark.table(self.trigrams).hint("merge").join(spark.table(self.pairs), KEY)
        return rows.select("w1", "w2", "w3", "n", "c12", "c23", "c2", "c3")

    def probabilities(self, spark: SparkSession, guarded: bool = False) -> DataFrame:
        return score(self.stats(spark), spark.table(self.trigrams), guarded)

    def drop(self, spark: SparkSession) -> None:
        """Forget the tables; their files go with the scratch folder."""
        for name in (self.trigrams, self.pairs):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _save(rows: DataFrame, name: str, buckets: int, key: list[Column], *words: str) -> None:
    """Grams are dealt as one string and taken apart afterwards, each bucket by one task into one file."""
    path = scratch_dir(rows.sparkSession, name)
    dealt = gram_words(rows.repartition(buckets, *key, "salt"), "gram", *words)
    dealt.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)


def _lay_out(grams: DataFrame, context: DataFrame, hot: list[str], buckets: int, salts: int) -> Layout:
    """``grams`` are ``(gram, n, c12)``, ``context`` is as ``pair_context`` gives it."""
    tag = uuid.uuid4().hex
    layout = Layout(f"trigrams_{tag}", f"pairs_{tag}")

    def word(place: int) -> Column:
        return F.coalesce(F.get(F.split("gram", " "), F.lit(place)), F.lit(""))

    def is_hot(first: int) -> Column:
        return word(first).isin(hot) & word(first + 1).isin(hot)

    salt = F.when(is_hot(1), F.pmod(F.xxhash64(word(0)), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    _save(grams.select("gram", "n", "c12", salt.alias("salt")), layout.trigrams, buckets, [word(1), word(2)], "w1", "w2", "w3")
    copies = F.when(is_hot(0), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    pairs = context.select(F.concat_ws(" ", "w2", "w3").alias("gram"), "c23", "c2", "c3")
    pairs = pairs.select("*", F.explode(copies).alias("salt"))
    _save(pairs, layout.pairs, buckets, [word(0), word(1)], "w2", "w3")
    return layout


def write_layout(trigrams: DataFrame, buckets: int = BUCKETS, salts: int = SALTS) -> Layout:
    """Lay out counted trigrams ``(w1, w2, w3, n)``."""
    counted = stored(trigrams, "trigrams")
    roles = stored(pair_roles(counted), "roles")
    grams = with_first_pair(counted, bigram_totals(roles)).select(F.concat_ws(" ", "w1", "w2", "w3").alias("gram"), "n", "c12")
    return _lay_out(grams, pair_context(roles), hot_words(unigram_totals(roles)), buckets, salts)


def write_text_layout(docs: DataFrame, buckets: int = BUCKETS, salts: int = SALTS) -> Layout:
    """Lay out the trigrams of a text. They are shuffled twice: as sightings, and counted, into their buckets."""
    grams, context, hot, _ = grams_and_context(docs)
    return _lay_out(grams, context, hot, buckets, salts)
