"""Near-duplicate documents by bottom-k sketches of one hash function.

The sketch of a document keeps the smallest hashes of its shingle set. Inverted lists are held per
residue class, on the class's smallest retained values together, so a passage that many documents
share makes a common list only where it makes up most of them. Documents that meet in a list are
first estimated on the union of their sketches and then verified on their full sets.

Equal sets are folded before. In a list every document is first held against one centre, the one
that meets most others. Where lists still hold several components, their documents are joined on
the rarest shingles of their full sets, which bounds the overlap exactly. So copies are not spread
into pairs, no pair of different sets is left out, and no list is one task.

Defined results: a null or empty text has no shingles and links with nothing; neither does a row
with a null id, whose component is null and which is kept; rows that share an id share a
component; an empty table gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components
from .shingles import WIDTH, mixed, shingle_sets

RETAINED = 64
CLASSES = 24
TOGETHER = 3
CENTRES = 2
LARGE = 64
BLOCK = 512
DEVIATIONS = 4.5
_NONE = np.uint64(2**64 - 1)


def list_keys(found: np.ndarray, classes: int = CLASSES, together: int = TOGETHER) -> np.ndarray:
    """One key per residue class that occurs: the class and its smallest values."""
    if not len(found):
        return np.zeros(0, np.int64)
    low = found[: max(4096, 64 * classes * together)]  # smallest first, enough for all classes; checked below
    residue = (low % np.uint64(classes)).astype(np.int64)
    if len(low) < len(found) and np.bincount(residue, minlength=classes).min() < together:
        low, residue = found, (found % np.uint64(classes)).astype(np.int64)
    order = np.argsort(residue, kind="stable")
    residue, low = residue[order], low[order]
    start = np.flatnonzero(np.concatenate([[True], residue[1:] != residue[:-1]]))
    size = np.diff(np.concatenate([start, [len(low)]]))
    key = residue[start].astype(np.uint64)
    for k in range(together):
        value = np.where(size > k, low[np.minimum(start + k, len(low) - 1)], _NONE)
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + value)
    return key.view(np.int64)


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """id, n_shingles, `digest` of the set, `sketch` and `keys`, null without shingles, and `version`, a hash of the text."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, version, found in zip(batch["id"], batch["version"], shingle_sets(batch["text"], width)):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
                rows.append((key, version, len(found), digest, found[:RETAINED].tobytes(), list_keys(found)))
            yield pd.DataFrame(rows, columns=["id", "version", "n_shingles", "digest", "sketch", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("version"))
    return texts.mapInPandas(work, f"id {kind}, version long, n_shingles long, digest binary, sketch binary, keys array<long>")


def _padded(sketches) -> np.ndarray:
    out = np.full((len(sketches), RETAINED), _NONE)
    for row, raw in zip(out, sketches):
        values = np.frombuffer(raw, dtype=np.uint64)
        row[:len(values)] = values
    return out


def estimated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common values among the smallest of the union, per row of two arrays of sketches."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != _NONE
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    place = np.cumsum(~again & real, axis=1)
    common = (again & (place <= RETAINED)).sum(1)
    return common / np.maximum(1, np.minimum(RETAINED, place[:, -1]))


def _floor(share: float) -> float:
    return share - DEVIATIONS * (share * (1 - share) / RETAINED) ** 0.5


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: tuple[int, int] = (85, 100),
                   width: int = WIDTH) -> DataFrame:
    """Per row: id, `n_shingles`, `component_id`, `kept`. Links need intersection * least[1] >= union * least[0]."""
    part, whole = least
    sketches = materialize(sketched(docs, id_col, text_col, width))
    usable = sketches.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    # A class is one set; one text with its smallest id stands for it.
    one = F.struct("id", "version")
    classes = materialize(usable.groupBy("digest").agg(F.min(one).alias("c")).select(
        "digest", "c.id", "c.version", F.monotonically_increasing_id().alias("node")))
    named = usable.select("id", "digest").join(classes.select("digest", "node"), "digest")
    # An id that several rows share ties their sets together.
    shared = named.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("high")).where("b < high")
    links = materialize(named.join(shared, "id").where("node <> b").select(F.col("node").alias("a"), "b").distinct())

    # Lists with at least two different sets.
    firsts = sketches.join(classes, ["id", "version", "digest"]).dropDuplicates(["id", "version", "digest"])
    firsts = materialize(firsts.select("node", "id", "version", "n_shingles", "sketch", "keys"))
    postings = firsts.select("node", "n_shingles", F.explode("keys").alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = materialize(postings.join(sizes, "key"))
    lists = materialize(met.join(met.groupBy("node").agg(F.sum("size").alias("met")), "node").drop("size"))
    wanted = firsts.join(lists.select("node").distinct(), "node", "left_semi")
    small = wanted.select("node", "n_shingles", "sketch")
    sets = _full_sets(docs, id_col, text_col, width, wanted.select("node", "id", "version"))

    groups = None
    for turn in range(CENTRES):
        members = _with_groups(lists, groups)
        if turn:  # only large lists that are not settled
            open_keys = materialize(_unsettled(members).where(F.col("size") > LARGE).select("key"))
            if open_keys.isEmpty():
                break
            members = members.join(open_keys, "key")
        # First the document that meets most others, so the original of a family; then any one.
        rank = F.struct(-F.col("met") if not turn else F.xxhash64("node", F.lit(turn)), "node")
        centre = members.groupBy("key").agg(F.min_by(F.struct("node", "group"), rank).alias("c"))
        pairs = members.join(centre, "key").where("group <> c.group").select(
            F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b")).distinct()
        links = links.unionByName(_verified(_passed(pairs, small, part, whole), sets, part, whole))
        groups = materialize(components(links))
        links = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    rest = materialize(_verified(_prefix_pairs(_with_groups(lists, groups), sets, part, whole), sets, part, whole))
    if not rest.isEmpty():
        groups = components(links.unionByName(rest))

    named = classes.select("digest", "id", "node").join(groups, "node", "left").select(
        "digest", "id", F.coalesce("component", "node").alias("component"))
    least_id = named.groupBy("component").agg(F.min("id").alias("least"))
    found = named.select("digest", "component").join(least_id, "component").select("digest", "least")
    rows = sketches.select("id", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _unsettled(members: DataFrame) -> DataFrame:
    """The lists that hold more than one component."""
    return members.groupBy("key").agg(
        F.min("group").alias("low"), F.max("group").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high")


def _with_groups(lists: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return lists.withColumn("group", F.col("node"))
    known = groups.select("node", F.col("component").alias("group"))
    return lists.join(known, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _full_sets(docs: DataFrame, id_col: str, text_col: str, width: int, wanted: DataFrame) -> DataFrame:
    """The sorted shingle hashes of the nodes in lists, worked out again from their texts."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, found.tobytes()) for key, found in zip(batch["node"], shingle_sets(batch["text"], width))]
            yield pd.DataFrame(rows, columns=["node", "found"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("version"))
    once = texts.join(wanted, ["id", "version"]).dropDuplicates(["id", "version"])
    return materialize(once.select("node", "text").mapInPandas(work, "node long, found binary"))


def _passed(pairs: DataFrame, small: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose estimate comes near it."""
    bound = _floor(part / whole)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 5000):
                some = batch.iloc[at:at + 5000]
                good = estimated(_padded(some["x"]), _padded(some["y"])) >= bound
                yield some.loc[good, ["a", "b"]]

    one = small.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("x"))
    two = small.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("y"))
    both = pairs.join(one, "a").join(two, "b").where(
        (F.least("n", "m") * whole >= F.greatest("n", "m") * part)).select("a", "b", "x", "y")
    return both.mapInPandas(work, pairs.select("a", "b").schema)


def _verified(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs with the wanted similarity of their full sets."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                good.append(whole * common >= part * (len(x) + len(y) - common))
            yield batch.loc[np.array(good, bool), ["a", "b"]]

    one = sets.select(F.col("node").alias("a"), F.col("found").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("found").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInPandas(work, pairs.schema)


def _prefix_pairs(members: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs of different components in unsettled lists that can still have the similarity.

    Among these documents the shingles of each set are ordered from rare to common. Two sets with
    the similarity share a shingle among the first few of both, and what follows it must suffice
    for the overlap: an exact bound, which a text with many words of its own never meets.
    """
    kind = members.schema["node"].dataType.simpleString()
    keys = _unsettled(members).select("key")
    chosen = members.join(keys, "key").select("node", "group").distinct()

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                some = batch.iloc[at:at + 200]
                size = np.array([len(x) // 8 for x in some["found"]])
                yield pd.DataFrame({
                    "token": np.frombuffer(b"".join(some["found"]), np.int64), "node": some["node"].to_numpy().repeat(size),
                    "group": some["group"].to_numpy().repeat(size), "n": size.repeat(size)})

    tokens = materialize(sets.join(chosen, "node").select("node", "group", "found").mapInPandas(
        spread, f"token long, node {kind}, group {kind}, n long"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    by_rarity = W.partitionBy("node").orderBy("df", "token")
    first = F.col("n") - F.ceil(F.col("n") * part / F.lit(whole)) + 1
    prefix = tokens.join(counts, "token").withColumn("place", F.row_number().over(by_rarity) - 1).where(
        (F.col("place") < first) & (F.col("df") > 1))
    # What is left of the set from this place on must hold the overlap with a set of the least size.
    prefix = materialize(prefix.where((F.col("n") - F.col("place")) * whole >= F.col("n") * part).drop("df"))
    live = prefix.groupBy("token").agg(
        F.min("group").alias("low"), F.max("group").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cut = (
        prefix.join(live.where("low < high").select("token", "blocks"), "token")
        .withColumn("own", F.pmod(F.xxhash64("node", "token"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "group", "n", "place")
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(rows):
                last = (rows[["token", "i", "j"]] == rows[["token", "i", "j"]].iloc[-1]).all(axis=1)
                held = rows[last]
                yield from pairs(rows[~last])
        if held is not None:
            yield from pairs(held)

    def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.reset_index(drop=True)
        node, group, n, left = (rows[c].to_numpy() for c in ("node", "group", "n", "place"))
        left = n - left
        own, i, j = (rows[c].to_numpy() for c in ("own", "i", "j"))
        out, waiting = [], 0
        for at in rows.groupby(["token", "i", "j"]).indices.values():
            same = i[at[0]] == j[at[0]]
            a, b = (at, at) if same else (at[own[at] == i[at]], at[own[at] == j[at]])
            x, y = np.repeat(a, len(b)), np.tile(b, len(a))
            fits = group[x] != group[y]
            if same:
                fits &= x < y
            x, y = x[fits], y[fits]
            # overlap * (part + whole) >= part * (sizes) is what the similarity asks for.
            fits = np.minimum(left[x], left[y]) * (part + whole) >= part * (n[x] + n[y])
            x, y = node[x[fits]], node[y[fits]]
            if len(x):
                out.append(pd.DataFrame({"x": x, "y": y}))
                waiting += len(x)
            if waiting > 200_000:
                yield pd.concat(out).drop_duplicates()
                out, waiting = [], 0
        if out:
            yield pd.concat(out).drop_duplicates()

    ordered = cut.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    found = ordered.mapInPandas(work, f"x {kind}, y {kind}")
    return found.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def keep_one_of_each(docs: DataFrame, least: tuple[int, int] = (80, 100)) -> DataFrame:
    """The documents that no smaller id of their component stands for."""
    gone = near_documents(docs, least=least).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
