"""Document fingerprints by threshold-scaled sketches.

A text becomes its distinct five-word shingles (a text of one to four words is
one shingle), each hashed to 63 bits. The sketch keeps every hash below a fixed
fraction of the hash range, so its size follows the text and two sketches of
very unequal texts still hold comparable samples: |A and B| / |smaller| of the
sketches estimates containment of the texts. The least hash is always kept, so
only a text without words has an empty sketch. Sketches merge: the sketch of
two texts together is made from the union of their sketches by the same rule.

Plan of the next-document comparison. Documents go to ranges of doc_id (bounds
are quantiles, at most MAX_RANGES) in one shuffle of the texts; a window inside
each range, descending doc_id, looks one row ahead. The first document of the
next range comes along as one extra "guest" row, found from the greatest id of
each range (one number per range on the driver). No task sees more than a
range, and no second shuffle is needed.

Defined results: a null text is the empty text; empty texts have the empty
fingerprint; two empty sketches are alike (1.0), an empty and another one are
not (0.0); a null doc_id sorts after all others; rows with equal doc_id are
ordered by text; a single document is its own next document; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import words
from quarry.session import local_table

SHINGLE = 5
FRACTION = 1 / 8          # share of the hash range that a sketch keeps
ROWS_PER_RANGE = 1500
MAX_RANGES = 4096         # ranges beyond this many rows just grow (windows spill)
STEP = 64                 # bounds searched at once, twice
LOWEST = -(2**63)


def sketch(text: Column, fraction: float = FRACTION) -> Column:
    """Ascending array of the kept shingle hashes of a text."""
    limit = int(fraction * 2**63)

    def of(word_hashes: Column) -> Column:
        n = F.size(word_hashes)
        shingles = F.when(
            n >= SHINGLE,
            F.transform(F.sequence(F.lit(0), n - SHINGLE),
                        lambda i: F.xxhash64(*[word_hashes[i + k] for k in range(SHINGLE)]))
        ).when(n > 0, F.array(F.xxhash64(word_hashes))).otherwise(F.array().cast("array<bigint>"))
        return F.transform(shingles, lambda h: F.shiftrightunsigned(h, 1))

    def kept(hashes: Column) -> Column:
        # hashes and their least one are bound together, so that neither is
        # computed again for every element
        return _let(F.struct(hashes.alias("h"), F.array_min(hashes).alias("m")),
                    lambda s: F.filter(s["h"], lambda u: (u < limit) | (u == s["m"])))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(_let(hashed, lambda ws: _let(of(ws), kept))))


def _let(value: Column, body) -> Column:
    """`body(value)` with the value computed once (array<bigint> results)."""
    return F.flatten(F.transform(F.array(value), lambda v: body(v)))


def fingerprint(sketched: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, ascending, comma-joined."""
    return F.array_join(F.transform(sketched, lambda h: F.lower(F.hex(h))), ",")


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both texts' shingles together."""
    limit = int(fraction * 2**63)
    return F.sort_array(_let(
        F.struct(F.array_union(a, b).alias("h"), F.least(F.array_min(a), F.array_min(b)).alias("m")),
        lambda s: F.filter(s["h"], lambda u: (u < limit) | (u == s["m"]))))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger has."""
    low = F.least(F.size(a), F.size(b))
    both = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(both, 1.0).when(low == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / low)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, 1.0).otherwise(shared / F.greatest(union, F.lit(1)))


# The next document --------------------------------------------------------------

def _bounds(keyed: DataFrame, rows_per_range: int) -> list[int]:
    n = keyed.count()
    ranges = min(MAX_RANGES, max(1, math.ceil(n / rows_per_range)))
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = keyed.agg(F.percentile_approx("_k", shares, 20 * ranges).alias("b")).first()["b"]
    return sorted(set(found))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the key: found among every STEP-th bound
    first, then among the STEP bounds after it."""
    if not bounds:
        return F.lit(0)
    fine = F.expr("array(" + ", ".join(f"{b}L" for b in bounds) + ")") if min(bounds) > LOWEST else F.array(
        *[F.lit(b).cast("bigint") for b in bounds])
    coarse = bounds[STEP - 1::STEP]
    if not coarse:
        return F.size(F.filter(fine, lambda b: b < key))
    steps = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in coarse]), lambda b: b < key))
    return steps * STEP + F.size(F.filter(F.slice(fine, steps * STEP + 1, STEP), lambda b: b < key))


def with_next(docs: DataFrame, extra: dict[str, Column], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`doc_id`, `_t` (text, null as empty), the `extra` columns made from
    `_t`, and `_next_<name>` of the next document for `_t` and each extra."""
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    keyed = base.withColumn("_k", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST).cast("bigint")))
    bounds = _bounds(keyed.select("_k"), rows_per_range)
    keyed = keyed.withColumn("_r", _range_of(F.col("_k"), bounds))
    # at most MAX_RANGES rows: the greatest id of each range that has rows
    tops = sorted((r["_r"], r["top"]) for r in keyed.groupBy("_r").agg(F.max("_k").alias("top")).collect())
    guests = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    visits = local_table(spark, {"_k": "bigint", "_v": "int"}, [(k, v) for k, v in guests if k > LOWEST])
    low = [v for k, v in guests if k == LOWEST]
    rows = keyed.join(F.broadcast(visits), "_k", "left")
    if low:   # every id of the range is null
        rows = rows.withColumn("_v", F.when(F.col("_k") == F.lit(LOWEST).cast("bigint"), low[0]).otherwise(F.col("_v")))
    names = ["_t", *extra]
    placed = (rows.select("doc_id", "_k", "_t", "_r", "_v").withColumns(extra)
              .select("doc_id", "_k", *names, F.explode(F.filter(
                  F.array(F.struct(F.col("_r").alias("r"), F.lit(False).alias("guest")),
                          F.struct(F.col("_v").alias("r"), F.lit(True).alias("guest"))),
                  lambda p: p["r"].isNotNull())).alias("_p"))
              .withColumns({"_r": F.col("_p.r"), "_guest": F.col("_p.guest")}))
    w = Window.partitionBy("_r").orderBy("_guest", F.col("_k").desc(), "_t")
    return (placed.withColumns({f"_next_{n.lstrip('_')}": F.lead(n).over(w) for n in names})
            .where(~F.col("_guest")).drop("_k", "_r", "_p", "_guest"))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half (rounded down, in code points) replaced by
    as many first code points of the next text, or all it has."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def query(docs: DataFrame) -> DataFrame:
    pairs = with_next(docs, {"_s": sketch(F.col("_t"))})
    both = pairs.withColumn("_e", edited(F.col("_t"), F.col("_next_t")))
    done = both.select(
        "doc_id", F.length("_t").cast("bigint").alias("n_chars"), F.sha2("_e", 256).alias("edited_sha256"),
        "_s", "_next_s", sketch(F.col("_e")).alias("_es"))
    s, es, ns = F.col("_s"), F.col("_es"), F.col("_next_s")
    return done.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(s).alias("fingerprint"), fingerprint(es).alias("edited_fingerprint"),
        containment(s, es).alias("near_edited"), containment(s, ns).alias("near_next"),
        resemblance(s, es).alias("jaccard_edited"), resemblance(s, ns).alias("jaccard_next"))
