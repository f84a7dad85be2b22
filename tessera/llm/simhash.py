"""SimHash near-dedup: multi-index hashing over 64-bit fingerprints.

Fingerprints are built per document in one Arrow pass (XXH64 of every word
shingle, majority bit).  Rows of equal fingerprint collapse to one before
anything is compared.  The 64 bits are cut into ``SEGMENTS`` equal segments; by
the pigeonhole principle two fingerprints that differ in at most ``d`` bits
differ in at most ``r = d // SEGMENTS`` bits within one segment.  Each
fingerprint therefore enumerates the Hamming ball of radius ``r`` around each
of its segments, fetches the fingerprints filed under these values in the
segment's table and verifies the complete distance.

A value under which very many fingerprints are filed (dense groups of near
copies) is not compared pair by pair.  There the rest of the bits is covered
by exact star keys: within one table value ``v`` every filed fingerprint
publishes all points ``x`` at distance ``<= 1`` of its other bits as *near*
and those at distance ``<= 2`` as *far*; a probe that reached ``v`` at distance
1 publishes its points at distance ``<= 1`` as far.  All members of ``(v, x)``
are linked to its smallest near member.  Each such link is at most 3 bits
(2 + 1, or 1 + 1 + 1) and every pair within 3 bits shares such an ``x``, so the
components are exactly those of the pairwise links, at a cost linear in the
members.  This path is exact for ``d = 3`` and two segments, the production
setting; for other settings every value goes through the pairwise path.

Defined results: null and empty texts have no word and the fingerprint zero,
linked like any other; texts shorter than a shingle are one shingle; ties and
repeated rows share a fingerprint and hence a component; rows repeated with
one id are one document; a null id never becomes a component id unless the
whole component has none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, slices, written

SEED = 42  # fixed value of the contract
SEGMENTS = 2
#: Table values with more fingerprints than this take the star path (same result, linear cost).
DENSE = 64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest, view = xxhash.xxh64_intdigest, joined
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(view[a:b], SEED) for a, b in spans), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        part = hashes[k : k + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(_id, fp)`` per row, the fingerprint as a signed long."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.fromiter((fingerprint(v or b"", shingle) for v in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["_id", "fp"])

    return slim.mapInArrow(run, f"_id {kind}, fp long")


def _ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` bits set."""
    return [
        sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(width), r)
    ]


def _segment(fp, s: int, width: int):
    return F.shiftrightunsigned(fp, s * width).bitwiseAND(F.lit((1 << width) - 1))


def links(distinct: DataFrame, distance: int = 3, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of ``distinct.fp`` within ``distance`` bits.

    Every returned link is itself within the distance.
    """
    if 64 % segments:
        raise ValueError("segments must divide 64")
    width, radius = 64 // segments, distance // segments
    star = distance == 3 and segments == 2
    fp = F.col("fp")
    flips = _ball(width, radius)
    filed = distinct.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), _segment(fp, s, width).alias("v")) for s in range(segments)])).alias("k")
    ).select("fp", "k.s", "k.v")
    probes = filed.select(
        "fp", "s", "v", F.explode(F.array(*[F.lit(m).cast("long") for m in flips])).alias("flip")
    ).select("fp", "s", F.col("v").bitwiseXOR(F.col("flip")).alias("v"), (F.col("flip") != 0).alias("off"))
    if star:
        crowded = written(filed.groupBy("s", "v").agg(F.count("*").alias("n")).where(F.col("n") > dense), "crowded").select("s", "v")
        sparse = filed.join(crowded, ["s", "v"], "left_anti")
    else:
        sparse = filed
    table = sparse.select("s", "v", F.col("fp").alias("b"))
    close = (F.col("fp") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= distance)
    # A link is found from both ends; the probe with the smaller fingerprint reports it.
    # Spark sizes a table after an explode as the one before it, so it would broadcast what does not fit the driver
    pairs = probes.hint("merge").join(table.hint("merge"), (probes.s == table.s) & (probes.v == table.v) & close).select(F.col("fp").alias("a"), "b")
    if not star:
        return pairs.distinct()

    def points(members: DataFrame, other, radius_: int, near_radius: int) -> DataFrame:
        masks = _ball(width, radius_)
        return members.withColumn("m", F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))).select(
            "s", "v", other.bitwiseXOR(F.col("m")).alias("x"), "fp", (F.bit_count("m") <= near_radius).alias("near")
        )

    rest = F.when(F.col("s") == 0, _segment(fp, 1, width)).otherwise(_segment(fp, 0, width))
    inside = filed.join(crowded, ["s", "v"])
    outside = probes.where("off").join(crowded, ["s", "v"]).select("fp", "s", "v")
    stars = points(inside, rest, 2, 1).union(points(outside, rest, 1, -1))
    heads = stars.where("near").groupBy("s", "v", "x").agg(F.min("fp").alias("head"))
    spokes = stars.hint("merge").join(heads.hint("merge"), ["s", "v", "x"]).where("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    return pairs.union(spokes).distinct()


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3, dense: int = DENSE
) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable)."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("_id").alias("rep")), "distinct-fp")
    found = connected_components(links(distinct.select("fp"), distance, dense=dense))
    rooted = distinct.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_fp = rooted.join(smallest.hint("merge"), "root").select("fp", "component_id")
    return fps.join(by_fp.hint("merge"), "fp").select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """The rows of ``docs`` whose id leads its component (rows with a null id stay when their component has no id)."""
    lead = components(docs, id_col, text_col, shingle, distance).where(F.col(id_col).eqNullSafe(F.col("component_id")))
    lead = lead.select(F.col(id_col).alias("_lead")).distinct()
    return docs.join(lead, docs[id_col].eqNullSafe(lead["_lead"]), "left_semi")
