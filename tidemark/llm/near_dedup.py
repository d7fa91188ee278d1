"""Near duplicates by an LSH forest, with links confirmed on full shingle sets.

Each tree orders the distinct shingle sets by its own sequence of minimum hashes. Sets that agree
on the first ``depth`` of them form a region of the tree. In a small region all pairs are
candidates. A large region is refined: along its sorted order each set meets the neighbour with
the longest common prefix, and links contract it to a few components; the sets outside its largest
component are then compared with the whole region in blocks, likest pairs first. Links found there
join components at once, so a pair of a region stays unjudged only if both are connected already.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.links import components
from tidemark.llm.text import bare
from tidemark.llm.word_hash import WordHashes, windows

SHINGLE = 5
#: Links join sets with this much of their union in common, if nothing else is asked for.
PERCENT = 85
HASHES = 160
#: Hashes of a tree beyond its depth, by which large regions are sorted.
BEYOND = 4
#: Largest share of pairs, at exactly the percentage of a link, that share no region of the forest.
MISS = 4e-7
#: Largest share of them that have fewer equal minimum hashes than are asked for.
UNLIKE = 4.5e-7
SMALL = 24
#: Sets per block when a large region is compared with those outside its largest component.
BLOCK = 1000

_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_SKETCH = "doc_id long, n_shingles long, fp binary, sig array<int>"


class Forest(NamedTuple):
    """What is set by ``percent``: links join sets with that much of their union in common."""

    percent: int
    trees: int
    depth: int
    length: int
    least_equal: int


@cache
def forest(percent: int) -> Forest:
    """The deepest forest of ``HASHES`` that keeps to ``MISS``, and the cut that keeps to ``UNLIKE``.

    At 85 % these are 20 trees of depth 4 and 112 equal hashes, at 80 % 21 of depth 3 and 101.
    """
    share = percent / 100
    if not 0 < share < 1:
        raise ValueError(f"percent must be between 0 and 100, not {percent}")
    trees = lambda depth: math.ceil(math.log(MISS) / math.log1p(-(share**depth)))
    depth = 0
    while trees(depth + 1) * (depth + 1 + BEYOND) <= HASHES:
        depth += 1
    if not depth:
        raise ValueError(f"{HASHES} hashes are too few for links at {percent} %")
    least, below = 0, 0.0
    while True:
        below += math.comb(HASHES, least) * share**least * (1 - share) ** (HASHES - least)
        if below > UNLIKE:
            return Forest(percent, trees(depth), depth, depth + BEYOND, least)
        least += 1


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of all words, where there are fewer."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(windows(hashes.of(words), min(SHINGLE, len(words))))


def _signature(own: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 1024):
        np.minimum(least, (_FACTORS[:, None] * own[None, i : i + 1024]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _print(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_set(t, hashes) for t in batch["text"]]
        out = pd.DataFrame(
            {
                "doc_id": batch["doc_id"], "n_shingles": [len(s) for s in sets],
                "fp": [_print(s) for s in sets],
                "sig": [_signature(s) if len(s) else None for s in sets],
            }
        )
        yield out.assign(row_key=batch["row_key"]) if "row_key" in batch else out


def _full_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        sets = [shingle_set(t, hashes) for t in batch["text"]]
        yield pd.DataFrame({"fp": [_print(s) for s in sets], "own": [s.tobytes() for s in sets]})


def _regions(vertices: DataFrame, shape: Forest) -> DataFrame:
    """``tree, head, tail, fp, n``: all regions with several sets, and their size."""
    trees = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(shape.trees - 1)),
            lambda t: F.struct(
                t.alias("tree"),
                F.slice("sig", t * shape.length + 1, shape.depth).alias("head"),
                F.slice("sig", t * shape.length + shape.depth + 1, BEYOND).alias("tail"),
            ),
        )
    ).alias("x")
    rows = vertices.select("fp", trees).select(
        F.xxhash64("x.tree", "x.head").alias("region"), "x.tail", "fp"
    )
    sizes = rows.groupBy(F.col("region").alias("r")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(sizes, F.col("region") == F.col("r")).drop("r")


def _ordered_pairs(frame: DataFrame) -> DataFrame:
    return frame.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _small_pairs(regions: DataFrame) -> DataFrame:
    """All pairs of regions of at most ``SMALL`` sets."""
    own = regions.where(F.col("n") <= SMALL)
    left, right = own.select("region", F.col("fp").alias("a")), own.select("region", F.col("fp").alias("b"))
    return left.join(right, "region").where("a < b").select("a", "b").distinct()


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adjacent rows of a sorted partition that lie in one region."""
    last: tuple | None = None
    for batch in batches:
        region, fp = batch["region"].tolist(), batch["fp"].tolist()
        if last:
            region, fp = [last[0], *region], [last[1], *fp]
        pairs = [
            (fp[i], fp[i + 1]) for i in range(len(fp) - 1) if region[i] == region[i + 1]
        ]
        if fp:
            last = (region[-1], fp[-1])
        yield pd.DataFrame(pairs, columns=["a", "b"])


def _large_neighbours(large: DataFrame) -> DataFrame:
    """Neighbours in the sorted orders of large regions. Ranges of the order share no task."""
    keyed = large.select("region", *[F.get("tail", i).alias(f"t{i}") for i in range(BEYOND)], "fp")
    order = keyed.columns
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return _ordered_pairs(ranged.select("region", "fp").mapInPandas(_neighbours, "a binary, b binary"))


def _likely(pairs: DataFrame, vertices: DataFrame, shape: Forest) -> DataFrame:
    """Pairs whose minimum hashes and sizes allow a link."""
    side = lambda k: vertices.select(
        F.col("fp").alias(k), F.col("sig").alias(f"sig_{k}"), F.col("n_shingles").alias(f"n_{k}")
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    equal = F.aggregate(
        F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * shape.percent
    return both.where(fits & (equal >= shape.least_equal)).select("a", "b")


def _confirm(percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [
                _linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                for a, b in zip(batch["own_a"], batch["own_b"], strict=True)
            ]
            yield batch.loc[np.array(kept, bool), ["a", "b"]]

    return confirm


def _confirmed(pairs: DataFrame, sets: DataFrame, shape: Forest) -> DataFrame:
    side = lambda k: sets.select(F.col("fp").alias(k), F.col("own").alias(f"own_{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return written(both.mapInPandas(_confirm(shape.percent), "a binary, b binary"))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compare(queries: pd.DataFrame, targets: pd.DataFrame, shape: Forest) -> pd.DataFrame:
    """Confirmed links that join components of a block; likest pairs first.

    A pair is passed over once links of this block have joined its components.
    """
    out, root = [], {}

    def find(part: bytes) -> bytes:
        while part in root:
            part = root[part]
        return part

    if len(queries) and len(targets):
        theirs = np.stack(targets["sig"].to_list())
        sets = [np.frombuffer(x, np.uint64) for x in targets["own"]]
        sizes = np.array([len(x) for x in sets])
        parts, names = targets["part"].tolist(), targets["fp"].tolist()
        for fp, part, sig, own in queries[["fp", "part", "sig", "own"]].itertuples(index=False):
            mine = np.frombuffer(own, np.uint64)
            equal = (theirs == np.asarray(sig)).sum(axis=1)
            fits = np.minimum(sizes, len(mine)) * 100 >= np.maximum(sizes, len(mine)) * shape.percent
            likely = np.flatnonzero((equal >= shape.least_equal) & fits)
            for t in likely[np.argsort(-equal[likely], kind="stable")].tolist():
                here, there = find(part), find(parts[t])
                if here != there and _linked(mine, sets[t], shape.percent):
                    out.append((fp, names[t]))
                    root[here] = there
    return pd.DataFrame(out, columns=["a", "b"])


def _left_over(
    large: DataFrame, vertices: DataFrame, sets: DataFrame, parts: DataFrame, shape: Forest
) -> DataFrame:
    """Links inside large regions that join components which are apart yet."""
    own = large.select("region", "fp").join(
        parts.select(F.col("node").alias("fp"), F.col("component").alias("part")), "fp", "left"
    ).select("region", "fp", F.coalesce("part", "fp").alias("part"))
    sizes = own.groupBy("region", "part").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy(F.col("region").alias("r")).agg(
        F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("all")
    ).where("most.n < all").select(
        "r", F.col("most.part").alias("main"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("most.n")) / BLOCK).cast("int").alias("q_blocks"),
    )
    rows = written(own.join(most, F.col("region") == F.col("r")))
    full = vertices.select("fp", "sig").join(sets, "fp")
    cut = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fresh = [F.col(c).alias(c) for c in ("region", "fp", "part")]
    targets = rows.select(*fresh, cut("blocks").alias("block"), upto("q_blocks").alias("q")).join(full, "fp")
    queries = rows.where("part <> main").select(
        *fresh, upto("blocks").alias("block"), cut("q_blocks").alias("q")
    ).join(full.select(*[F.col(c).alias(c) for c in full.columns]), "fp")
    keys = ["region", "block", "q"]

    def compare(queries: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
        return _compare(queries, targets, shape)

    return _ordered_pairs(
        queries.groupBy(*keys).cogroup(targets.groupBy(*keys)).applyInPandas(compare, "a binary, b binary")
    )


def near_duplicates(
    documents: DataFrame, *, percent: int = PERCENT, key: str | None = None
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    A set holds the distinct 5-word shingles of a text after lower-casing A-Z, words being cut at
    ASCII white space; with fewer words the whole sequence is one shingle. Sets are linked when
    they have at least ``percent`` % of their union in common. ``component_id`` is the least ``doc_id``
    reachable and ``kept`` says that it is the row's own. Null, empty and blank texts have an empty
    set and are linked with nothing. Equal sets are one vertex, so repeated rows and copies are
    never paired; null ids are greater than any other and the component of nulls alone is null. An
    empty table gives an empty result; further columns are not read, but for a binary one that
    ``key`` names, which each row keeps as ``row_key``.
    """
    shape = forest(percent)
    own = bare(documents).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = [] if key is None else ["row_key"]
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *[F.col(key).alias(k) for k in keyed],
    )
    schema = ", ".join([_SKETCH, *[f"{k} binary" for k in keyed]])
    sketches = written(read.mapInPandas(_sketches, schema))
    vertices = written(
        sketches.where("fp IS NOT NULL").groupBy("fp").agg(
            F.min("doc_id").alias("low"), F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("sig").alias("sig"),
        )
    )
    regions = written(_regions(vertices, shape))
    large = regions.where(F.col("n") > SMALL)
    first = written(_likely(_small_pairs(regions).unionByName(_large_neighbours(large)).distinct(), vertices, shape))
    ends = first.select(F.col("a").alias("fp")).unionByName(first.select(F.col("b").alias("fp")))
    needed = ends.unionByName(large.select("fp")).distinct()
    # Texts are fetched by the least id of their set; a row with that id and another set falls out.
    ids = vertices.join(needed, "fp", "left_semi").select(F.col("low").alias("id")).distinct()
    texts = own.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = written(
        texts.mapInPandas(_full_sets, "fp binary, own binary")
        .join(needed, "fp", "left_semi").dropDuplicates(["fp"])
    )
    found = _confirmed(first, sets, shape)
    parts = written(components(found))
    more = written(_left_over(large, vertices, sets, parts, shape))
    if not more.isEmpty():
        joined = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        parts = written(components(joined.unionByName(more)))
    lows = parts.join(vertices.select(F.col("fp").alias("node"), "low"), "node")
    least = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    linked = lows.join(least, "component").select(F.col("node").alias("fp"), "component_id")
    named = vertices.select("fp", "low").join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "low").alias("component_id")
    )
    return sketches.select("doc_id", "n_shingles", "fp", *keyed).join(named, "fp", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *keyed,
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
