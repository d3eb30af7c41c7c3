"""Near-duplicate documents: an inverted join on the coordinates of MinHash signatures.

Documents with equal shingle sets form one class. Each class posts its
signature under every (coordinate, value) pair. Two sets of similarity 0.85
agree in at least `MATCHES` of `COORDINATES` values but with a chance of about
6e-7, so they share a value among the `COORDINATES - MATCHES + 1` rarest of
either (prefix merging); longer lists are skipped, and their collisions are
counted in the signatures. Every pair that reaches the threshold is confirmed
on full shingle sets.

Only connectivity is asked for. A first round compares neighbours in the
posting lists, sorted by the rest of the signature, which is linear and joins
most copies. A second one takes the lists that still hold several components:
the classes they connect form pools, and pools are compared block by block, where
only pairs of different components count and only links are put out. No list is
cut and no pair above the threshold left out.

Empty: a document without words has no shingles and no links. Repeated rows
are copies of one another and get the same result each. Null ids: such rows
have no component and are kept. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .texts import bytes_of, frugal, kept, pieces, shingles, texts, word_hashes

COORDINATES = 32
MATCHES = 16
PREFIX = COORDINATES - MATCHES + 1
SIMILAR = 85  # percent
SHINGLE = 5
# Rows of a block of a pool; beyond eight of the largest, a pool has more blocks.
LEAST_BLOCK, LARGEST_BLOCK = 512, 8192
# Links that `components` leaves to one task, whatever the size of the input.
ONE_TASK = 20_000

_rng = np.random.default_rng(5)
_FACTOR = _rng.integers(1, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_SHIFT = _rng.integers(1, 2**64, COORDINATES, dtype=np.uint64)


def signature(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values, one row per set; `starts` tells where the sets begin in `sets` (none empty)."""
    out = np.empty((len(starts), COORDINATES), np.uint64)
    for j in range(COORDINATES):
        out[:, j] = np.minimum.reduceat(sets * _FACTOR[j] + _SHIFT[j], starts)
    return out.view(np.int64)


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    hashes, at = word_hashes(*bytes_of(batch.column("text")))
    return [shingles(hashes[a:b], SHINGLE) for a, b in zip(at[:-1], at[1:])]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in pieces(whole, "text"):
            sets = _sets(batch)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            signs: list = [None] * len(sets)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                for i, row in zip(full, signature(np.concatenate([sets[i] for i in full]), starts)):
                    signs[i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array(signs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "sig"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the classes; a row that has the id but another text of it is left out."""
    for whole in batches:
        for batch in pieces(whole, "text"):
            rows = [
                (rep, s.tobytes())
                for rep, key, s in zip(batch.column("doc_id").to_pylist(), batch.column("set_key").to_pylist(), _sets(batch))
                if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == key
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["rep", "set"]
            )


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of consecutive rows of one posting list with enough matches."""
    last = None
    for rows in batches:
        if last is not None:
            rows = pd.concat([last, rows], ignore_index=True)
        last = rows.tail(2)
        if len(rows) < 2:
            continue
        key, rep = rows["key"].to_numpy(), rows["rep"].to_numpy()
        signs = np.stack(rows["sig"].to_numpy())
        for back in (1, 2):
            same = (key[back:] == key[:-back]) & ((signs[back:] == signs[:-back]).sum(axis=1) >= MATCHES)
            a, b = rep[:-back][same], rep[back:][same]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < SIMILAR * len(y):
        return False
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[place] == x).sum())
    return 100 * common >= SIMILAR * (len(x) + len(y) - common)


@F.pandas_udf(T.BooleanType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between components, cell by cell; a cell is two blocks of one pool, and rows come sorted by it."""
    rest = None
    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        key = rows[["pool", "c", "d"]].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts):
            yield _cell_links(rows.iloc[a:b])
        rest = rows.iloc[cuts[-1] :] if len(cuts) else rows
    if rest is not None and len(rest):
        yield _cell_links(rest)


def _cell_links(rows: pd.DataFrame) -> pd.DataFrame:
    rep, component, block = (rows[c].to_numpy() for c in ("rep", "component", "block"))
    signs = np.stack(rows["sig"].to_numpy())
    sets = [np.frombuffer(s, np.uint64) for s in rows["set"]]
    sizes = np.array([len(s) for s in sets])
    c, d = rows["c"].iat[0], rows["d"].iat[0]
    left, right = (np.arange(len(rows)),) * 2 if c == d else (np.flatnonzero(block == c), np.flatnonzero(block == d))
    root = {x: x for x in component.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found: list[tuple[int, int]] = []
    for first in range(0, len(left), 256):
        own = left[first : first + 256]
        matches = np.zeros((len(own), len(right)), np.uint8)
        for j in range(COORDINATES):
            matches += signs[own, j][:, None] == signs[right, j][None, :]
        near = (matches >= MATCHES) & (component[own][:, None] != component[right][None, :])
        small, large = np.minimum(sizes[own][:, None], sizes[right][None, :]), np.maximum(sizes[own][:, None], sizes[right][None, :])
        near &= 100 * small >= SIMILAR * large
        for i, k in zip(*np.nonzero(near)):
            i, k = own[i], right[k]
            # A pair whose components have met in this cell needs no link of its own.
            if (c != d or i < k) and (x := find(int(component[i]))) != (y := find(int(component[k]))) and similar(sets[i], sets[k]):
                root[max(x, y)] = min(x, y)
                found.append((int(min(rep[i], rep[k])), int(max(rep[i], rep[k]))))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").where(_similar("set_a", "set_b")).select("a", "b")


def _roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every node of at most `ONE_TASK` links, and the smallest node it is connected with."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    for rows in batches:
        for a, b in zip(rows["a"].tolist(), rows["b"].tolist()):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    yield pd.DataFrame({"from": list(root), "to": [find(x) for x in list(root)]}, dtype="int64")


def _hooks(links: DataFrame) -> DataFrame:
    """Nodes that have a lower neighbour, and where hooking each to its smallest one leads in the end."""
    hooks = kept(links.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to")))
    while True:
        on = hooks.select(F.col("from").alias("mid"), F.col("to").alias("end"))
        seen = Observation()
        hooks = kept(
            hooks.join(on, F.col("to") == F.col("mid"), "left").observe(seen, F.count("end").alias("n"))
            .select("from", F.coalesce("end", "to").alias("to"))
        )
        if seen.get["n"] == 0:
            return hooks


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, its smallest reachable node, of every node of `links` (a < b; a kept table).

    Each round hooks every node that has a lower neighbour to the smallest one, follows
    the hooks to their ends by doubling, and goes on with the links between these ends, so
    the graph shrinks however long its chains are. Once at most `ONE_TASK` links are left,
    one task solves the rest.
    """
    labels = None
    while True:
        last = links.count() <= ONE_TASK
        hooks = kept(links.repartition(1).mapInPandas(frugal(_roots), "from long, to long")) if last else _hooks(links)
        if labels is None and last:
            return hooks.select(F.col("from").alias("node"), F.col("to").alias("component"))
        if labels is None:
            labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
        labels = kept(_moved(labels, hooks, "component"))
        if last:
            return labels
        links = kept(
            _moved(_moved(links, hooks, "a"), hooks, "b").where("a != b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )


def _moved(df: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    """`df` with the nodes in `column` replaced by where they hook to."""
    moved = df.join(hooks, F.col(column) == F.col("from"), "left")
    return moved.withColumn(column, F.coalesce("to", column)).drop("from", "to")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: `doc_id`, `n_shingles`, `component_id` (smallest linked id), `kept`."""
    signed = kept(
        texts(docs).mapInArrow(frugal(_sign), "doc_id long, n_shingles long, set_key binary, sig array<long>")
    )
    usable = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = kept(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    )
    posted = classes.select("rep", F.posexplode("sig").alias("at", "value")).select(
        F.xxhash64("at", "value").alias("key"), "at", "rep"
    )
    shared = posted.groupBy("key").agg(F.count("*").alias("freq")).where("freq > 1")
    # Values that nobody shares come first in a class's order; they fill its prefix.
    ordered = (
        posted.join(shared, "key").groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("freq", "key", "at"))).alias("lists"))
        .withColumn("take", F.size("lists") - (COORDINATES - PREFIX)).where("take > 0")
        .select("rep", F.explode(F.slice("lists", 1, F.col("take"))).alias("list"))
        .select("rep", "list.key", "list.at")
    )
    prefixes = kept(ordered.join(classes, "rep"))
    wanted = prefixes.select(F.col("rep").alias("doc_id"), "set_key").distinct()
    sets = kept(
        texts(docs).join(wanted, "doc_id").dropDuplicates(["doc_id", "text"])
        .mapInArrow(frugal(_full_sets), "rep long, set binary"),
    )

    # Round 1: neighbours in the lists, sorted by the signature from the list's coordinate on.
    turned = prefixes.withColumn(
        "turn", F.concat(F.slice("sig", F.col("at") + 1, COORDINATES), F.slice("sig", 1, F.col("at")))
    )
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = (
        turned.repartitionByRange(parts, "key", "turn").sortWithinPartitions("key", "turn", "rep")
        .select("key", "rep", "sig").mapInPandas(frugal(_neighbours), "a long, b long").where("a < b").distinct()
    )
    links = kept(_confirmed(kept(near), sets))
    labels = components(links)

    # Round 2: pairs that share a list and lie in different components.
    labelled = prefixes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("rep").alias("first")
    ).where("low < high").select("key", "first")
    open_lists = kept(labelled.join(mixed, "key"))
    # Classes connected by such lists form a pool; pairs are looked for inside of pools only.
    pools = components(
        kept(open_lists.where("first < rep").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct())
    ).select(F.col("node").alias("rep"), F.col("component").alias("pool"))
    sizes = pools.groupBy("pool").agg(F.count("*").alias("size")).withColumn(
        "blocks", F.ceil(F.col("size") / F.least(F.lit(LARGEST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.col("size") / 8)))
    )
    members = open_lists.select("rep", "component").distinct().join(pools, "rep").join(sizes, "pool").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))
    )
    rows = members.join(classes.select("rep", "sig"), "rep").join(sets, "rep")
    cell = [F.least("block", "other").alias("c"), F.greatest("block", "other").alias("d")]
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "pool", *cell, "block", "rep", "component", "sig", "set"
    )
    more = kept(
        cells.repartition(parts, "pool", "c", "d").sortWithinPartitions("pool", "c", "d", "rep")
        .mapInPandas(frugal(_across), "a long, b long"),
    )
    labels = components(links.unionByName(more))

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component_id")
    )
    return signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Rows of `docs` without near duplicates: the smallest id of each component stays, once."""
    found = kept(near_duplicates(docs).select("doc_id", "kept").where("doc_id IS NOT NULL"))
    by_id = found.groupBy("doc_id").agg(F.max("kept").alias("any_kept"), F.count("*").alias("rows"))
    gone = kept(by_id.where(~F.col("any_kept")).select(F.col("doc_id").alias("__id")))
    several = kept(by_id.where("any_kept AND rows > 1").select(F.col("doc_id").alias("__id")))
    rest = docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
    once = rest.join(several, rest["doc_id"] == several["__id"], "left_anti")
    repeated = rest.join(several, rest["doc_id"] == several["__id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)
