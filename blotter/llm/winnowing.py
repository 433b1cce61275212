"""Document fingerprints by winnowing.

Every run of ``K`` code points is hashed, and of every ``W`` hashes in a row
the smallest is kept with its position, the rightmost of equal ones. Two texts
that share ``K + W - 1`` code points in a row share a kept hash.

Minima of windows come from five passes over the hashes, each taking the
smaller of two neighbours at distance 1, 2, 4, 8, 16, so a text costs the same
per code point however long it is. A long text is worked off in blocks that
overlap by a window. The first window that keeps a hash tells which hashes a
prefix of the text keeps, so the fingerprint of an edited text follows from
those of its two parts and the windows across the cut. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import let, only

K = 12
W = 32
#: Windows worked off at once; positions in a block take ``PLACE_BITS`` bits.
BLOCK = 8_192
PLACE_BITS = 14
#: Ranges of ids that neighbours are looked up in; more of them for more data.
RANGES = 256
_PLACES = (1 << PLACE_BITS) - 1


def _of_two(values: Column, apart: int) -> Column:
    return let(
        values,
        lambda a: F.zip_with(a, F.slice(a, apart + 1, F.greatest(F.size(a), F.lit(1))), lambda x, y: F.least(x, y)),
    )


def winnowed(text: Column) -> Column:
    """array<struct<hash, position, first>>: kept hashes in order of position.

    ``first`` is the first window that keeps it. A text shorter than ``K`` is
    one hash, one with fewer than ``W`` hashes has one window; null and empty
    texts keep nothing.
    """
    n = F.length(text)
    grams = F.greatest(n - K + 1, F.lit(1))
    windows = F.greatest(grams - W + 1, F.lit(1))
    zero = F.lit(0)

    def block(data: Column, start: Column) -> Column:
        keys = F.transform(
            F.sequence(zero, F.least(F.lit(BLOCK + W - 1), grams - start) - 1),
            lambda i: F.xxhash64(F.substring(data, (start + i) * 4 + 1, F.lit(4 * K)))
            .bitwiseAND(F.lit(~_PLACES))
            .bitwiseOR(F.lit(_PLACES) - i),
        )
        least = keys
        for apart in (1, 2, 4, 8, 16):
            least = _of_two(least, apart)
        least = F.slice(least, 1, F.least(F.lit(BLOCK), windows - start))
        changes = let(least, lambda m: F.filter(m, lambda x, i: ~x.eqNullSafe(F.get(m, i - 1))))
        return F.transform(
            changes,
            lambda x: F.struct(
                F.shiftright(x, PLACE_BITS).alias("hash"),
                (start + (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES)))).cast("int").alias("position"),
            ),
        )

    whole = let(
        F.encode(text, "UTF-32"),
        lambda data: F.flatten(
            F.transform(F.sequence(zero, windows - 1, F.lit(BLOCK)), lambda start: block(data, start))
        ),
    )
    once = let(
        whole, lambda a: F.filter(a, lambda x, i: ~x["position"].eqNullSafe(F.get(a, i - 1)["position"]))
    )

    def first(a: Column, x: Column, i: Column) -> Column:
        before = F.get(a, i - 1)
        entered = x["hash"] <= before["hash"]
        return F.when(i == 0, 0).when(entered, x["position"] - W + 1).otherwise(before["position"] + 1)

    kept = let(
        once,
        lambda a: F.transform(
            a, lambda x, i: F.struct(x["hash"].alias("hash"), x["position"].alias("position"), first(a, x, i).alias("first"))
        ),
    )
    none = F.array().cast("array<struct<hash:bigint,position:int,first:int>>")
    return F.when(F.coalesce(n, zero) > 0, kept).otherwise(none)


def hashes(kept: Column) -> Column:
    """The distinct hashes in order: equal for equal texts."""
    return F.array_sort(F.array_distinct(F.transform(kept, lambda x: x["hash"])))


def of_prefix(kept: Column, length: Column) -> Column:
    """What windows inside the first ``length`` code points keep."""
    return F.filter(kept, lambda x: x["first"] <= length - (W + K - 1))


def joined(left: Column, left_text: Column, left_n: Column, right: Column, right_text: Column, right_n: Column) -> Column:
    """Hashes that the first ``left_n`` code points of one text and then the
    first ``right_n`` of another keep, given what both whole texts keep."""
    reach = W + K - 2
    across = F.concat(
        F.substring(left_text, F.greatest(left_n - reach, F.lit(0)) + 1, F.least(left_n, F.lit(reach))),
        F.substring(right_text, F.lit(1), F.least(right_n, F.lit(reach))),
    )
    cut = F.when((left_n > reach) & (right_n == 0), F.lit("")).when((right_n > reach) & (left_n == 0), F.lit("")).otherwise(across)
    return hashes(F.concat(of_prefix(left, left_n), winnowed(cut), of_prefix(right, right_n)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes; two empty fingerprints are alike."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - shared
    return F.when(both == 0, 1.0).otherwise(shared / both)


def digest(of: Column) -> Column:
    """32 hexadecimal digits for a list of hashes."""
    return F.lower(
        F.concat(F.lpad(F.hex(F.xxhash64(of)), 16, "0"), F.lpad(F.hex(F.xxhash64(of, F.lit("2"))), 16, "0"))
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``kept`` (see ``winnowed``) for every row."""
    source = only(docs, doc_id=id_col, text=text_col)
    return source.select("doc_id", winnowed(F.coalesce("text", F.lit(""))).alias("kept"))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of ``bounds`` (in order) lie below ``value``; 0 for null."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    firsts = F.array(*[F.lit(p[0]) for p in parts])
    nested = F.array(*[F.array(*[F.lit(b) for b in p]) for p in parts])
    above = lambda a: F.size(F.filter(a, lambda b: b < value))
    inner = let(above(firsts), lambda c: F.when(c == 0, 0).otherwise((c - 1) * step + above(F.get(nested, c - 1))))
    return F.when(value.isNull(), 0).otherwise(inner)


def with_next(docs: DataFrame, kept: str, ranges: int = RANGES) -> DataFrame:
    """Rows of ``docs`` with ``next``: a struct of ``text``, ``n`` and ``kept``
    of the document with the next smaller id, or of the largest after the last.

    Ids are cut at percentiles into ranges, and a copy of the last rows of each
    range goes to the one behind it, so one shuffle brings neighbours together.
    The driver holds one bound and one largest id per range. Ids that repeat
    are ordered by the hash of their texts; rows without id come last.
    """
    shares = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("c")).first()["c"]
    bounds = sorted(set(cuts or []))
    placed = docs.withColumn("range", _range_of(F.col("doc_id"), bounds))
    ends = {r["range"]: r["last"] for r in placed.groupBy("range").agg(F.max("doc_id").alias("last")).collect()}
    filled = sorted(ends)
    follows = [(ends[r], filled[(i + 1) % len(filled)]) for i, r in enumerate(filled) if ends[r] is not None]
    if filled and ends[filled[-1]] is None:
        follows.append((None, filled[0]))
    ghosts = docs.sparkSession.createDataFrame(follows, "last long, range int")
    copies = docs.join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("last"))).drop("last")
    dealt = (
        placed.withColumn("ghost", F.lit(False))
        .unionByName(copies.withColumn("ghost", F.lit(True)))
        .repartition("range")
        .withColumn(kept, winnowed(F.col("text")))
    )
    order = Window.partitionBy("range").orderBy(F.desc("ghost"), F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    following = F.lag(F.struct("text", "n", F.col(kept).alias("kept"))).over(order)
    return dealt.withColumn("next", following).where("not ghost").drop("ghost", "range")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES) -> DataFrame:
    """Fingerprints of documents, of edited documents, and how alike they are.

    The edited text of a document has its last half (rounded down) replaced by
    the first as many code points (or all) of the next document. Columns:
    ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``, ``n_kept``. Null
    texts count as empty; a single document is its own next; an empty table
    gives an empty one. Ids are whole numbers.
    """
    source = only(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(source.withColumn("n", F.length("text")), "kept", ranges)
    cut = F.floor(F.col("n") / 2).cast("int")
    left_n, right_n = F.col("n") - cut, F.least(cut, F.col("next.n"))
    edited = F.concat(F.substring("text", F.lit(1), left_n), F.substring(F.col("next.text"), F.lit(1), right_n))
    edited_hashes = joined(F.col("kept"), F.col("text"), left_n, F.col("next.kept"), F.col("next.text"), right_n)
    result = let(
        F.struct(
            hashes(F.col("kept")).alias("own"),
            edited_hashes.alias("edited"),
            hashes(F.col("next.kept")).alias("next"),
        ),
        lambda s: F.struct(
            digest(s["own"]).alias("fingerprint"),
            digest(s["edited"]).alias("edited_fingerprint"),
            likeness(s["own"], s["edited"]).alias("near_edited"),
            likeness(s["own"], s["next"]).alias("near_next"),
            F.size(s["own"]).alias("n_kept"),
        ),
    )
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), result.alias("r")
    ).select("doc_id", "n_chars", "edited_sha256", "r.*")
