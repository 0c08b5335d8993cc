"""Near-duplicate groups by b-bit MinHash.

Word shingles are hashed, and of 128 permutations the minima are taken. Bands
of full minima generate candidates; of each minimum only the low ``BITS`` bits
are kept and packed into longs. Two packed signatures are compared by bit
counts, and the share of agreeing slots is corrected for slots that agree by
chance: ``(share - 2**-b) / (1 - 2**-b)``.

Documents with the same packed signature are one node from the start, so that
thousands of copies cost no pairs. In each bucket all nodes are compared with
the least; those that it does not link are compared with every node of the
bucket. The pairs left out are of nodes that the least node links already, so
the groups are those of all pairs. Groups are connected components.

Defined results: null and empty texts have no shingles and are never near to
anything; they stay. Texts shorter than a shingle are one shingle. Rows that
repeat both doc_id and text are one document. Ties are broken by (doc_id, text
hash); doc_ids are integers (ValueError otherwise), a null one sorts first, as
-2**63 does. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import NO_ID, free, key
from .scratch import drop, written
from .textcore import Words, mix, shingles, signed, slices

K, H, TEXT = "_mh_key", "_mh_hash", "_mh_text"
#: BITS may be 1, 2, 4 or 8.
PERMUTATIONS, BITS, ROWS, SHINGLE = 128, 2, 4, 3
THRESHOLD = 0.7
LONGS = PERMUTATIONS * BITS // 64

_rng = np.random.default_rng(77)
_MUL = _rng.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def accept(threshold: float = THRESHOLD) -> float:
    """The estimate from which a pair counts: two standard errors under the threshold, so that pairs at it are found."""
    share = 2.0**-BITS + (1 - 2.0**-BITS) * threshold
    return threshold - 2 * (share * (1 - share) / PERMUTATIONS) ** 0.5 / (1 - 2.0**-BITS)


def minima(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """PERMUTATIONS x texts; texts without shingles have the largest value."""
    n = len(offsets) - 1
    out = np.full((PERMUTATIONS, n), 2**32 - 1, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    step = 1 << 15  # so many shingles at a time, to stay in cache
    begins = offsets[full]
    lo = 0
    while lo < len(full):
        hi = max(lo + 1, int(np.searchsorted(offsets[full + 1], begins[lo] + step, side="right")))
        part = hashes[begins[lo] : offsets[full[hi - 1] + 1]]
        cuts = begins[lo:hi] - begins[lo]
        for p in range(PERMUTATIONS):
            x = part * _MUL[p]
            x += _ADD[p]
            x >>= np.uint64(32)
            out[p, full[lo:hi]] = np.minimum.reduceat(x, cuts)
        lo = hi
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """LONGS x texts: the low bits of minima, 64 / BITS to a long."""
    per = 64 // BITS
    bits = (low & np.uint32(2**BITS - 1)).astype(np.uint64)
    out = np.zeros((LONGS, low.shape[1]), np.uint64)
    for i in range(PERMUTATIONS):
        out[i // per] |= bits[i] << np.uint64(BITS * (i % per))
    return out


def bands(low: np.ndarray) -> np.ndarray:
    """(PERMUTATIONS / ROWS) x texts keys."""
    out = []
    for b in range(PERMUTATIONS // ROWS):
        key = np.full(low.shape[1], b + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[b * ROWS + r])
        out.append(key)
    return np.array(out)


SIGS = [f"s{i}" for i in range(LONGS)]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, TEXT):
            hashes, offsets = shingles(Words.of(part.column(TEXT)), SHINGLE)
            low = minima(hashes, offsets)
            keys = np.ascontiguousarray(bands(low).T)
            some = np.diff(offsets) > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some * keys.shape[1]))).astype(np.int32)), pa.array(signed(keys[some].ravel())))
            yield pa.RecordBatch.from_arrays([part.column(K), part.column(H), *(pa.array(signed(s)) for s in packed(low)), lists], [K, H, *SIGS, "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    return docs.select(K, H, TEXT).mapInArrow(_signatures, f"{K} long, {H} long, {', '.join(f'{s} long' for s in SIGS)}, bands array<long>")


def similarity(a: str, b: str) -> Column:
    """Collision-corrected estimate from the packed signatures in columns a_s0 ... and b_s0 ..."""
    mask = int(("0" * (BITS - 1) + "1") * (64 // BITS), 2)  # the lowest bit of each slot
    mask -= (mask >> 63) << 64
    off: list[Column] = []
    for s in SIGS:
        x = F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))
        off.append(F.bit_count(reduce(Column.bitwiseOR, [F.shiftright(x, i) for i in range(BITS)]).bitwiseAND(F.lit(mask))))
    share = 1 - reduce(Column.__add__, off) / F.lit(float(PERMUTATIONS))
    return (share - 2.0**-BITS) / (1 - 2.0**-BITS)


def _with_least(edges: DataFrame, written_as: str) -> tuple[DataFrame, DataFrame]:
    """edges with m, the least b of their a, and the table of these, which a hub of very many edges comes to after map-side combine."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), written_as)
    return edges.join(least, "a"), least


def components(edges: DataFrame, written_as: str = "mh-components") -> DataFrame:
    """(node, root): the least node of each node's component, for nodes of edges (a, b).

    Alternates large-star and small-star steps until the edges no longer change;
    every step's edges are a written table, so a lost executor costs one step.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), written_as)
    sums = None
    while True:
        both, first = _with_least(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), written_as)
        large = written(both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a != b").distinct(), written_as)
        small, second = _with_least(large, written_as)
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a != b").distinct()
        after = written(small, written_as)
        for gone in (edges, first, large, second):
            drop(gone)
        edges = after
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sums:
            roots = edges.withColumnsRenamed({"a": "node", "b": "root"})
            roots._scratch = edges._scratch
            return roots
        sums = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(_mh_key, _mh_hash, root_key, root_hash): the document that stays of each document's group."""
    keyed = docs.select(key(docs, id_col).alias(K), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias(H), F.col(f"`{text_col}`").alias(TEXT))
    place = F.struct(K, H)
    # A node is named by a hash of its signature; texts without shingles aren't near to each other.
    node = F.when(F.size("bands") == 0, F.xxhash64(K, H)).otherwise(F.xxhash64(*SIGS))
    members = written(signatures(keyed).withColumn("node", node), "mh-signatures")
    least = members.groupBy("node").agg(F.min(F.struct(K, H, "bands", *SIGS)).alias("x"))
    nodes = written(least.select("node", "x.bands", *[f"x.{s}" for s in SIGS]), "mh-nodes")
    sigs = nodes.select("node", *SIGS)

    # The least node leads its bucket: any fixed choice will do. Buckets are aggregated with map-side combine, so that one that
    # very many share is no task of its own, and written, so that adaptive execution may split it in the join.
    keys = nodes.select("node", F.explode("bands").alias("band"))
    leads = written(keys.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead != last").select("band", "lead"), "mh-leads")
    keys = written(keys.join(leads, "band").where("lead != node").select("band", "lead", "node"), "mh-buckets")

    def close(pairs: DataFrame) -> DataFrame:
        left, right = (sigs.select(F.col("node").alias(n), *[F.col(s).alias(f"{n}_{s}") for s in SIGS]) for n in ("a", "b"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", (similarity("a_", "b_") >= accept(threshold)).alias("near"))

    led = written(close(keys.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()), "mh-led")
    far = keys.join(led.where("not near").select(F.col("a").alias("lead"), F.col("b").alias("node")), ["lead", "node"], "left_semi").select("band", F.col("node").alias("a"))
    rest = far.join(keys.select("band", F.col("node").alias("b")), "band").where("a != b")
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = led.where("near").select("a", "b").union(close(rest).where("near").select("a", "b"))
    roots = components(edges)

    grouped = written(members.select(K, H, "node").join(roots, "node", "left").select(K, H, F.coalesce("root", "node").alias("root")), "mh-grouped")
    top = written(grouped.groupBy("root").agg(F.min(place).alias("top")), "mh-first")
    for gone in (members, nodes, leads, keys, led, roots):
        drop(gone)
    return grouped.join(top, "root").select(K, H, F.col(f"top.{K}").alias("root_key"), F.col(f"top.{H}").alias("root_hash"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without all but the first document, by (doc_id, text hash), of each group; repeated rows go too."""
    found = near_duplicates(docs, id_col, text_col, threshold)
    k, h = (free(docs, x) for x in (K, H))
    kept = written(found.where(f"{K} = root_key and {H} = root_hash").select(F.col(K).alias(k), F.col(H).alias(h)).distinct(), "mh-kept")
    keyed = docs.withColumns({k: key(docs, id_col), h: F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))})
    out = keyed.join(kept, [k, h], "left_semi").dropDuplicates([k, h])
    return out.select(*[f"`{c}`" for c in docs.columns])


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document that stays: doc_id, and in copies, sorted, the doc_ids of all of its group; null ones count and come first."""
    found = near_duplicates(docs, id_col, text_col, threshold).distinct()
    by_id = lambda c: F.nullif(c, F.lit(NO_ID))
    out = found.groupBy("root_key", "root_hash").agg(F.sort_array(F.collect_list(K)).alias("copies"))  # which drops nulls
    return out.select(by_id(F.col("root_key")).alias("doc_id"), F.size("copies").alias("n_copies"), F.transform("copies", by_id).alias("copies"))
