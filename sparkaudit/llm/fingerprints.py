"""Document fingerprints by consistent weighted sampling. DataFrame functions only.

Terms are words, weights their counts. For each of ``size`` samples a term draws a
gamma-distributed r and c and a uniform b from its hash; with t = floor(ln w / r + b) the
sample is the term that minimises c / exp(r (t - b) + r), together with t. Two texts
agree on a sample with probability equal to the generalised Jaccard similarity of their weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 32
_LOW = (1 << 31) - 1
_WORDS = r"[ \t\n\r\f\x0b]+"


def _uniform(bits: Column, width: int) -> Column:
    return (bits + F.lit(0.5)) / F.lit(float(1 << width))


def _sample(term: Column, log_weights: list[Column], k: int) -> list[Column]:
    """For sample ``k`` and each weight: rank in the upper, identity in the lower 31 bits; null without weight."""
    h1, h2 = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    mask = F.lit((1 << 25) - 1).cast("bigint")

    def pair(h):
        return _uniform(h.bitwiseAND(mask), 25) * _uniform(F.shiftrightunsigned(h, 25).bitwiseAND(mask), 25)

    r, c = -F.log(pair(h1)), -F.log(pair(h2))
    b = _uniform(F.shiftrightunsigned(h1, 50) * F.lit(1 << 14) + F.shiftrightunsigned(h2, 50), 28)
    out = []
    for weight in log_weights:
        t = F.floor(weight / r + b)
        log_a = F.log(c) - r * (t - b) - r
        rank = F.greatest(F.floor((log_a + F.lit(64.0)) * F.lit(float(1 << 24))), F.lit(0).cast("bigint"))
        name = h1.bitwiseXOR(h2 + t * F.lit(0x9E3779B1)).bitwiseAND(F.lit(_LOW).cast("bigint"))
        out.append(rank * F.lit(1 << 31) + name)
    return out


def _likeness(a: str, b: str, size: int) -> Column:
    same = [F.when(F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}")), 1).otherwise(0) for k in range(size)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total / F.lit(float(size))


def _hex(prefix: str, size: int) -> Column:
    """Eight hex digits a sample; the empty string for a text without words."""
    return F.concat_ws("", *[F.lpad(F.lower(F.hex(F.col(f"{prefix}{k}"))), 8, "0") for k in range(size)])


def _chunk_of(key: Column, cuts: list, low: int = 0) -> Column:
    """How many of the ascending ``cuts`` are at or below the key, as a balanced tree of tests."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(key >= F.lit(cuts[mid]), _chunk_of(key, cuts[mid + 1 :], low + mid + 1)).otherwise(_chunk_of(key, cuts[:mid], low))


def with_next(docs: DataFrame, key: str, text: str, chunks: int) -> DataFrame:
    """Columns key, text, next, chunk, place, ghost: each row with the text behind it in descending key order.

    The key range is cut at approximate quantiles into ``chunks`` pieces, so the texts move
    once and no task sorts more than a piece. The first row of every piece is added as a
    ghost to the piece before it (the very first one to the last piece), where it is the
    next of the last row.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    at = [i / chunks for i in range(1, chunks)]
    found = rows.agg(F.percentile_approx("key", at, 10 * chunks)).first()[0] if at else None
    rows = rows.withColumn("chunk", F.coalesce(_chunk_of(F.col("key"), sorted(set(found or []))), F.lit(0)))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    heads = rows.groupBy("chunk").agg(F.max(F.struct("key", "tie")).alias("head"))  # at most `chunks` rows
    order = Window.orderBy("chunk")
    heads = heads.select(
        F.col("head.key").alias("h_key"), F.col("head.tie").alias("h_tie"),
        F.coalesce(F.lead("chunk").over(order), F.min("chunk").over(Window.partitionBy())).alias("target"),
    )
    ghosts = rows.join(F.broadcast(heads), F.col("key").eqNullSafe(F.col("h_key")) & (F.col("tie") == F.col("h_tie")))
    both = rows.withColumn("ghost", F.lit(False)).unionByName(
        ghosts.select("key", "text", F.col("target").alias("chunk"), "tie", F.lit(True).alias("ghost"))
    )
    descending = Window.partitionBy("chunk").orderBy("ghost", F.desc_nulls_last("key"), F.desc("tie"))
    return both.select(
        "key", "text", "chunk", "ghost", F.lead("text").over(descending).alias("next"),
        F.row_number().over(descending).alias("place"),
    )


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, chunks: int | None = None
) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half (rounded down) replaced by as many leading characters of
    the next document in descending key order (all of a shorter one; the first document
    follows the last). Null texts count as empty, null keys come last, rows with equal
    keys are ordered by a hash of the text. A text without words has the empty fingerprint, is
    like (1) another such text and unlike (0) any other. ``key`` is numeric; other columns
    are not read. After the one shuffle that brings neighbours together all steps stay in
    their partition: counts by (row, term), samples by row, comparison with the next row.
    """
    spark = docs.sparkSession
    chunks = chunks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = F.expr("length(text) div 2").cast("int")
    rows = with_next(docs, key, text, chunks).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr(F.coalesce("next", F.lit("")), F.lit(1), half))
    )
    # Cut both texts after their common words: [shared][own rest] and [shared][edited rest].
    kept = F.length("text") - half
    lead = F.substr("text", F.lit(1), kept)
    shared = F.greatest(kept - F.locate(" ", F.reverse(lead)) + 1, F.lit(0))
    shared = F.when(F.locate(" ", lead) > 0, shared).otherwise(F.lit(0))
    pieces = rows.withColumn("shared", shared).select(
        "chunk", "place",
        F.explode(F.array(
            F.struct(F.lit(1).alias("own"), F.lit(1).alias("new"), F.substr("text", F.lit(1), F.col("shared")).alias("t")),
            F.struct(F.lit(1).alias("own"), F.lit(0).alias("new"), F.substr("text", F.col("shared") + 1).alias("t")),
            F.struct(F.lit(0).alias("own"), F.lit(1).alias("new"), F.substr("edited", F.col("shared") + 1).alias("t")),
        )).alias("p"),
    )
    words = pieces.select("chunk", "place", "p.own", "p.new", F.explode(F.split("p.t", _WORDS)).alias("w"))
    counts = words.groupBy("chunk", "place", F.xxhash64("w").alias("term")).agg(
        F.sum(F.when(F.col("w") != "", F.col("own")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("w") != "", F.col("new")).otherwise(0)).alias("n1"),
    ).withColumns({f"l{side}": F.when(F.col(f"n{side}") > 0, F.log(F.col(f"n{side}").cast("double"))) for side in (0, 1)})
    samples = {}
    for k in range(size):
        for side, packed in enumerate(_sample(F.col("term"), [F.col("l0"), F.col("l1")], k)):
            samples[f"{'ae'[side]}{k}"] = packed
    drawn = counts.groupBy("chunk", "place").agg(*[F.min(v).alias(n) for n, v in samples.items()])
    drawn = drawn.withColumns({n: F.col(n).bitwiseAND(F.lit(_LOW).cast("bigint")) for n in samples})
    behind = Window.partitionBy("chunk").orderBy("place")
    drawn = drawn.withColumns({f"b{k}": F.lead(f"a{k}").over(behind) for k in range(size)})
    about = rows.where(~F.col("ghost")).select(
        "chunk", "place", "key", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
    )
    return about.join(drawn, ["chunk", "place"]).select(
        F.col("key").alias(key), "n_chars", "edited_sha256",
        _hex("a", size).alias("fingerprint"), _hex("e", size).alias("edited_fingerprint"),
        _likeness("a", "e", size).alias("near_edited"), _likeness("a", "b", size).alias("near_next"),
    )
