"""Prefix trie of conversations: every distinct sequence of first turns with its members and subtree.

A conversation is a path of node keys, one per turn: the key of a prefix is a digest of the sums of
keyed digests of its turns (four lanes of 32 bits per turn, SHA-256), so prefixes of a conversation
are running sums and a conversation may span partitions. Equal paths fold to one row with counts.
Paths are cut into ranges; the largest path of each range is a splitter, and the trie of the
splitter paths, the skeleton, is broadcast. A node outside the skeleton lies in one range, where a
pass over the sorted paths finishes it with a stack of open nodes. A node of the skeleton gets a
partial aggregate from each range that meets it; these are reduced by key and added up along the
skeleton. The skeleton has at most `LAYER` + 1 nodes per range, whatever the number of rows.

Paths longer than `LAYER` turns are cut into layers, so no row and no skeleton grows with the
length of a conversation. Layers are folded from the deepest: what lies below a layer's last turn
is added at the end of the path above it.

Defined results: a null role or text is empty; turns come by number, a null number first, and
equal numbers by a digest of role and text; repeated rows are turns each; rows without a
conversation id belong to no conversation; an empty table gives no nodes; columns other than the
four named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

LAYER = 256  # turns of a layer
CHUNK = 10_000  # ids that are written as one text before they are digested
LANES = 4

_NODE = ("key binary, depth long, parent binary, conv_id long, n_convs long, n_ends long, n_bytes long, n_children long, "
         "n_leaves long, saved_tokens long")
_FIELDS = [x.split()[0] for x in _NODE.split(", ")]
_TYPES = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def digest_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a digest of role and text, and the UTF-8 bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def _running(rows: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Add running sums inside each conversation; one may span the ranges of (conversation, order)."""
    by = [F.col(c).asc_nulls_first() for c in order]
    ranged = materialize(rows.repartitionByRange(F.col("conv_id"), *by).withColumn("__part", F.spark_partition_id()))
    within = W.partitionBy("__part", "conv_id").orderBy(*by).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("conv_id").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("conv_id", "__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    starts = parts.select("conv_id", "__part", *[F.sum(f"__{n}").over(before).alias(f"__{n}") for n in sums])
    # Only a conversation that goes on from one range into the next has rows here: one per range.
    starts = F.broadcast(starts.dropna())
    placed = ranged.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(starts, ["conv_id", "__part"], "left")
    return placed.withColumns({n: F.col(n) + F.coalesce(f"__{n}", F.lit(0)) for n in sums}).drop("__part", *[f"__{n}" for n in sums])


def number_turns(turns: DataFrame) -> DataFrame:
    """Digested turns with `position`, from 1 in each conversation."""
    return _running(turns, ["turn", "digest"], {"position": F.lit(1).cast("long")}).select(
        "conv_id", "position", "digest", "n_bytes")


def _key(lanes: list[Column], position: Column) -> Column:
    text = F.concat_ws(",", *[x.cast("string") for x in lanes], position.cast("string"))
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def paths(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Per conversation and layer: keys of the layer's prefixes, bytes of their last texts, the key before, and whether it is the last layer."""
    names = [f"lane{i}" for i in range(LANES)]
    own = F.sha2(F.concat_ws(":", F.col("position").cast("string"), "digest"), 256)
    lanes = {n: F.conv(F.substring(own, 8 * i + 1, 8), 16, 10).cast("long") for i, n in enumerate(names)}
    summed = _running(turns.withColumns({f"own_{n}": c for n, c in lanes.items()}), ["position"], {n: F.col(f"own_{n}") for n in names})
    opens = (F.col("position") - 1) % LAYER == 0
    keyed = summed.select(
        "conv_id", F.floor((F.col("position") - 1) / LAYER).alias("layer"), "position", "n_bytes",
        _key([F.col(n) for n in names], F.col("position")).alias("key"),
        F.when(opens, _key([F.col(n) - F.col(f"own_{n}") for n in names], F.col("position") - 1)).alias("before"))
    in_order = F.sort_array(F.collect_list(F.struct("position", "key", "n_bytes")))
    layered = keyed.groupBy("conv_id", "layer").agg(F.max("before").alias("start"), in_order.alias("turns")).select(
        "conv_id", "layer", "start", F.col("turns.key").alias("path"), F.col("turns.n_bytes").alias("sizes"))
    none = members.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("layer"), _key([F.lit(0)] * LANES, F.lit(0)).alias("start"),
        F.array().cast("array<binary>").alias("path"), F.array().cast("array<bigint>").alias("sizes"))
    last = F.col("layer") == F.max("layer").over(W.partitionBy("conv_id"))
    return layered.unionByName(none).select(
        "*", F.coalesce(F.try_element_at("path", F.lit(-1)), "start").alias("tip"), last.alias("last"))


def _skeleton(splitters: list[tuple[bytes, list[bytes]]], top: int) -> dict[bytes, tuple[int, bytes | None]]:
    """Depth and parent of all nodes on the splitter paths."""
    found: dict[bytes, tuple[int, bytes | None]] = {}
    for start, path in splitters:
        above = None
        for depth, key in enumerate([start, *path], top):
            found[key] = depth, above
            above = key
    return found


def _fold_shards(shards: DataFrame, skeleton: set[bytes], top: int) -> DataFrame:
    """Nodes below and at the starts of sorted paths; `open` marks partial aggregates of skeleton nodes, `split` nodes under one."""
    shared = shards.sparkSession.sparkContext.broadcast(skeleton)  # at most LAYER + 1 keys per range
    schema = _NODE + ", open boolean, split boolean"
    fields = [(x.split()[0], _TYPES[x.split()[1]]) for x in schema.split(", ")]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bones = shared.value
        stack: list[list] = []  # open nodes, with the values of _NODE
        out: list[list] = []

        def close():
            node = stack.pop()
            key, _, parent, least, convs, _, size, children, _, _ = node
            is_open = key in bones
            if not is_open:
                node[8] += not children
                node[9] += (convs - 1) * size
            out.append([*node, is_open, parent is None or parent in bones])
            if stack:
                above = stack[-1]
                above[3] = min(above[3], least)
                above[4] += convs
                if not is_open:
                    above[7] += 1
                    above[8] += node[8]
                    above[9] += node[9]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])

        for batch in batches:
            for row in batch.to_pylist():
                keys, sizes = [row["start"], *row["path"]], [0, *row["sizes"]]
                shared_turns = 0
                while shared_turns < min(len(stack), len(keys)) and stack[shared_turns][0] == keys[shared_turns]:
                    shared_turns += 1
                while len(stack) > shared_turns:
                    close()
                for i in range(shared_turns, len(keys)):
                    stack.append([keys[i], top + i, keys[i - 1] if i else None, row["conv_id"], 0, 0, sizes[i], 0, 0, 0])
                tip = stack[-1]
                tip[3] = min(tip[3], row["conv_id"])
                for place, name in ((4, "n_convs"), (5, "n_ends"), (7, "n_children"), (8, "n_leaves"), (9, "saved_tokens")):
                    tip[place] += row[name]
            if out:
                yield batch_of(out)
                out.clear()
        while stack:
            close()
        if out:
            yield batch_of(out)

    return shards.mapInArrow(fold, schema)


def _fold_layer(rows: DataFrame, layer: int) -> DataFrame:
    """All nodes of a layer's paths; the nodes that these start from come with what lies below them."""
    spark, top = rows.sparkSession, layer * LAYER
    ranged = materialize(rows.repartitionByRange("start", "path").withColumn("shard", F.spark_partition_id()))
    splitters = ranged.groupBy("shard").agg(F.max(F.struct("start", "path")).alias("s")).select("s.*").collect()
    skeleton = _skeleton([(bytes(s), [bytes(k) for k in p]) for s, p in splitters], top)
    shards = ranged.repartition("shard").sortWithinPartitions("shard", "start", "path").drop("shard")
    folded = materialize(_fold_shards(shards, set(skeleton), top))

    sums = ("n_convs", "n_ends", "n_children", "n_leaves", "saved_tokens")
    partial = folded.where("open").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("n_bytes").alias("n_bytes"), *[F.sum(c).alias(c) for c in sums])
    nodes = {bytes(r["key"]): r.asDict() for r in partial.collect()}
    for key in sorted(nodes, key=lambda k: -skeleton[k][0]):
        node, above = nodes[key], nodes.get(skeleton[key][1])
        node["n_leaves"] += not node["n_children"]
        node["saved_tokens"] += (node["n_convs"] - 1) * node["n_bytes"]
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += node["n_leaves"]
            above["saved_tokens"] += node["saved_tokens"]
    done = [tuple({**n, "key": k, "depth": skeleton[k][0], "parent": skeleton[k][1]}[f] for f in _FIELDS) + (True,)
            for k, n in nodes.items()]
    closed = folded.where("NOT open").drop("open")
    return closed.unionByName(spark.createDataFrame(done, _NODE + ", split boolean"))


def _digests(ends: DataFrame) -> DataFrame:
    """Per node, the SHA-256 of the ids of the conversations that end there, ascending, joined by commas.

    A digest is sequential, so one task reads a node; ids are joined to texts of up to `CHUNK` before.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                ["key", "first", "ids"])

        for batch in batches:
            for key, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (key != now or len(ids) == CHUNK):
                    yield chunk()
                    ids = []
                now = key
                ids.append(i)
        if ids:
            yield chunk()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["key", "ends_sha256"])
                done = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    ranged = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranged.mapInArrow(joined, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the trie of `turns` (conv_id, position from 1 without gaps, digest, n_bytes) of all `members` (conv_id, each once).

    Columns: `conv_id`, the smallest member; `depth`; `parent_conv_id`; `n_convs`, members;
    `n_children`; `n_leaves`, childless nodes in the subtree; `saved_tokens`, the sum over the
    subtree of (members - 1) times the bytes of the last text; `ends_sha256`, a digest of the
    members that end at the node.
    """
    layered = materialize(paths(turns, members))
    folded = materialize(layered.groupBy("layer", "tip").agg(
        F.any_value("start").alias("start"), F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("last").alias("n_ends")))
    nodes, below = None, None
    for layer in range(folded.agg(F.coalesce(F.max("layer"), F.lit(0))).first()[0], -1, -1):
        rows = folded.where(F.col("layer") == layer).drop("layer")
        if below is None:
            rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")})
        else:
            rows = rows.join(below, rows["tip"] == below["key"], "left").drop("key").na.fill(
                0, ["n_children", "n_leaves", "saved_tokens"])
        found = materialize(_fold_layer(rows.drop("tip"), layer))
        own = found if layer == 0 else found.where(F.col("depth") > layer * LAYER)
        below = found.where(F.col("depth") == layer * LAYER).select("key", "n_children", "n_leaves", "saved_tokens")
        nodes = own if nodes is None else nodes.unionByName(own)

    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # Nodes with children in many ranges are nodes of the skeleton, so they are few.
    few = F.broadcast(nodes.where("split").select("parent").distinct().join(parents, "parent"))
    named = nodes.where("split").join(few, "parent", "left").unionByName(nodes.where("NOT split").join(parents, "parent", "left"))
    ends = _digests(layered.where("last").select(F.col("tip").alias("key"), "conv_id"))
    return named.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """`prefix_nodes` of conversations as they stand."""
    turns = materialize(number_turns(digest_turns(conversations)))
    return prefix_nodes(turns, turns.select("conv_id").distinct())
