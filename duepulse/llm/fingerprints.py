"""Fingerprints of documents: every shingle hash below a fixed share of the hash range.

DataFrame functions only. Since the share is the same for all texts, sketches of a union are
unions of sketches, and the overlap of two sketches estimates how much of the smaller text the
larger one contains, however unequal they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tables

#: Words of a shingle; one in how many hashes stays in a fingerprint, where texts are often short.
WIDTH = 5
SCALE = 2
#: Documents that are ordered in one bucket, and buckets at most (their limits go with the plan).
BUCKET_ROWS = 2048
MOST_BUCKETS = 65_536


def sketch(text: Column, width: int = WIDTH, scale: int = 8) -> Column:
    """The sorted distinct hashes of the text's shingles that are below 1/scale of the range.

    A text with fewer words than a shingle has its whole sequence as its one shingle.
    """

    def hashes(words: Column) -> Column:
        last = F.size(words) - width + 1
        each = F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
            lambda i: F.xxhash64(*[F.try_element_at(words, i + k) for k in range(width)]),
        )
        return F.when(F.size(words) == 0, F.expr("array()").cast("array<bigint>")).otherwise(each)

    words = F.transform(F.regexp_extract_all(text, F.lit(tables.WORD), F.lit(0)), lambda w: F.xxhash64(w))
    all_hashes = F.flatten(F.transform(F.array(words), hashes))
    limit = (1 << 63) // scale
    return F.sort_array(F.array_distinct(F.filter(all_hashes, lambda h: F.shiftrightunsigned(h, 1) < limit)))


def merged(one: Column, other: Column) -> Column:
    """The sketch of two texts together, shingles across their seam left out."""
    return F.sort_array(F.array_union(one, other))


def containment(one: Column, other: Column) -> Column:
    """The share of the smaller sketch that is in the other; null if either is empty."""
    least = F.least(F.size(one), F.size(other))
    return F.when(least > 0, F.size(F.array_intersect(one, other)) / least)


def told(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ",")


def _likeness(one: Column, other: Column, text: Column, other_text: Column) -> Column:
    """Containment; texts too short to have hashes in their sketches are alike if equal."""
    return F.coalesce(containment(one, other), (text == other_text).cast("double"), F.lit(0.0))


def with_next(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, text, sketch) with next_text and next_sketch of the next larger doc_id.

    The last row's next is the first. Rows of one id are ordered by a hash of their text. Ids are
    cut into buckets at approximate quantiles; every bucket also gets the row after its last, so
    each is ordered by itself and a text is shuffled once. Rows without an id have no next.
    """
    ids = rows.where("doc_id is not null")
    count, least = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    buckets = min(MOST_BUCKETS, -(-count // BUCKET_ROWS)) if count else 1
    limits: list[int] = []
    if buckets > 1:
        at = [i / buckets for i in range(1, buckets)]
        found = ids.agg(F.percentile_approx("doc_id", at, 20 * buckets)).first()[0]
        limits = sorted(set(found) - {least})
    bucket, starts = _bucket(F.col("doc_id"), limits)
    none = F.lit(None).cast("long")
    places = F.array(
        F.struct(bucket.alias("bucket"), F.lit(0).alias("later")),
        F.struct(F.when(starts, bucket - 1).otherwise(none).alias("bucket"), F.lit(1).alias("later")),
        F.struct(F.when(F.col("doc_id") == (least or 0), F.lit(len(limits)).cast("long")).alias("bucket"), F.lit(2).alias("later")),
    )
    placed = (
        ids.withColumn("place", F.explode(F.filter(places, lambda p: p["bucket"].isNotNull())))
        .select("doc_id", "text", "place.bucket", "place.later").repartition("bucket")
        .withColumn("sketch", sketch(F.col("text"), scale=SCALE))
    )
    order = Window.partitionBy("bucket").orderBy("later", "doc_id", F.xxhash64("text"))
    followed = placed.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
    alone = rows.where("doc_id is null").withColumn("sketch", sketch(F.col("text"), scale=SCALE))
    alone = alone.withColumn("next_text", F.lit("")).withColumn("next_sketch", F.expr("array()").cast("array<bigint>"))
    return followed.where("later = 0").drop("bucket", "later").unionByName(alone)


def _bucket(key: Column, limits: list[int]) -> tuple[Column, Column]:
    """How many limits are at or below the key, found in two steps, and whether one equals it."""
    if not limits:
        return F.lit(0).cast("long"), F.lit(False)
    width = max(1, round(len(limits) ** 0.5))
    chunks = [limits[i : i + width] for i in range(0, len(limits), width)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda x: x <= key))
    first = below(longs([c[0] for c in chunks]))
    chunk = F.get(F.array(*[longs(c) for c in chunks]), first - 1)
    bucket = F.when(first > 0, (first - 1) * width + below(chunk)).otherwise(0).cast("long")
    return bucket, F.coalesce(F.array_contains(chunk, key), F.lit(False))


def fingerprint(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document's text and edited text, and how alike they are.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document by ascending doc_id, after the last the first. Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next; the last
    two are the containment of the smaller sketch in the other.

    Null text is empty. Empty texts, and short ones of which no hash stays, have the empty
    fingerprint; such a text is alike (1) only to an equal one, else 0. Repeated doc_ids follow
    one another in the order of their texts' hashes. Null doc_id: no next document, so the edited
    text is the first part alone. Extra columns, n_chars too, are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    both = with_next(rows).withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), scale=SCALE))
    one = F.col("sketch")
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        told(one).alias("fingerprint"), told(F.col("edited_sketch")).alias("edited_fingerprint"),
        _likeness(one, F.col("edited_sketch"), F.col("text"), F.col("edited")).alias("near_edited"),
        _likeness(one, F.col("next_sketch"), F.col("text"), F.col("next_text")).alias("near_next"),
    )
