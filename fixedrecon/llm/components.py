"""Connected components of links between ids, by stars that grow towards the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fixedrecon.llm.shared import removed, stored

SALTS = 64  # parts into which the links of one id are cut


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` with ``m``, the smallest neighbour ``b`` of each ``a``.

    An id may have a large share of all links. Its links are cut into ``SALTS`` parts by the hash of the neighbour: the
    minimum is taken within a part, then over the parts, and comes back to each part. So no task gets more than
    a part of an id's links, or one row for each part."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = salted.groupBy("a", "salt").agg(F.min("b").alias("m"))
    least = parts.withColumn("m", F.min("m").over(Window.partitionBy("a")))
    return salted.join(least, ["a", "salt"]).drop("salt")


def _large_stars(links: DataFrame) -> DataFrame:
    """Each larger neighbour of an id links to the smallest id around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_stars(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of an id, and the id itself, link to the smallest of them."""
    known = _with_least(links)
    pair = F.struct(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return known.select(pair.alias("x")).select("x.*").distinct()


def components(links: DataFrame) -> DataFrame:
    """``a``, ``b`` (longs, a > b) to one row (a, b) for each id that is not the smallest of its
    component: ``b`` is the smallest. No row for an id without links.

    Every round only groups by minimum and joins on an id and a part of its links, so an id with very many links
    is spread over tasks. Ids are never gathered; the driver reads one checksum a round. Rounds grow with the
    logarithm of a component's size. Links are ids that exist: a row with a null id is to be left out before."""
    current, mark = stored(links.distinct(), "links"), None
    while True:
        following = stored(_small_stars(_large_stars(current)), "links")
        found = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        removed(current)
        current = following
        if mark == found:
            return current
        mark = found
