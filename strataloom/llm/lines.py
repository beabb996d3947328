"""Removal of lines that nearly repeat an earlier line, by a segment-partition edit join.

Two lines are linked when at most `edits` insertions, deletions or substitutions of code points
turn one into the other. A line is cut into `edits` + 1 segments; a line within the threshold
holds one of them whole. So each line files its segments by length and number, and probes the
substrings that segments of an equally long or shorter line can match in it. Lines that meet are
verified with a banded bit-parallel edit distance, many pairs at a time, in blocks of a filed
segment; blocks return components of links, not pairs. Of each component of lines the first
occurrence, by document id and place, stays.

Shorter lines are allowed fewer edits: two from 24 code points on, one from 12 on, none below; of
two lines the shorter one counts. Lines of 12 to 23 code points are cut into two segments, and go
the same way. Equal lines need no meeting, they share their name. Blank lines below 24 code points
part paragraphs and stay. With a `least_chars` of the caller, lines below it are left alone instead.
Lines are named by 64 bits of a cryptographic digest of the whole line, so no two different lines
can be made to share a name. The polynomial hashes of segments only bring lines together.
Defined results: a null or empty text has no lines to remove and stays as it is; null ids come
after all others; rows that repeat id and text count as one row; an empty table gives an empty
table; columns other than id and text are passed through or not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components
from .shingles import _constants, _powers, mixed
from .text import GAPS, let, without

EDITS = 2
LEAST_CHARS = 24
ONE_EDIT_CHARS = 12
BLOCK = 512
_TOGETHER = 1_000_000  # code points hashed in one go; a longer text is hashed alone
_PAIR_CELLS = 4_000_000


class LineHashes:
    """Prefix polynomial hashes over code points; powers are kept and grow."""

    def __init__(self):
        self.base = int(_constants(1, 21)[0])
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        if len(self.up) < len(codes) + 1:
            n = max(1 << 16, 2 * len(codes))
            self.up, self.down = _powers(self.base, n), _powers(pow(self.base, -1, 2**64), n)
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(0x51_7C_C1_B7)) * self.up[:len(codes)], out=out[1:])
        return out

    def between(self, sums, start, size):
        return (sums[start + size] - sums[start]) * self.down[start]


def _lines(texts, least: int, short: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some texts at a time: their code points, and text number, line number, start and size of the lines
    from `least` code points on, with `short` also of those below that are not blank."""
    def found(some: list[str], first: int):
        codes = np.frombuffer("\n".join(some).encode("utf-32-le") + b"\n\0\0\0", dtype="<u4")
        ends = np.flatnonzero(codes == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        text_start = np.cumsum([0] + [len(t) + 1 for t in some[:-1]])
        text = np.searchsorted(text_start, starts, side="right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, text_start)[text]
        size = ends - starts
        keep = size >= least
        if short:
            solid = np.concatenate([[0], np.cumsum((codes != 32) & ((codes < 9) | (codes > 13)))])
            keep |= solid[ends] > solid[starts]
        return codes, text[keep] + first, number[keep], starts[keep], size[keep]

    some, size, first = [], 0, 0
    for at, text in enumerate(texts):
        if some and size + len(text) > _TOGETHER:
            yield found(some, first)
            some, size, first = [], 0, at
        some.append(text)
        size += len(text) + 1
    if some:
        yield found(some, first)


def _line_ids(codes, start, size) -> np.ndarray:
    raw = codes.tobytes()
    digests = [blake2b(raw[a:b], digest_size=8).digest() for a, b in zip((4 * start).tolist(), (4 * (start + size)).tolist())]
    return np.frombuffer(b"".join(digests), dtype="<i8")


def occurrences(docs: DataFrame, least: int, short: bool = False) -> DataFrame:
    """The lines of each row of `doc`, `digest`, `text`: doc, digest, `line_no`, `line`."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for codes, text, number, start, size in _lines(batch["text"], least, short):
                yield pd.DataFrame({"doc": batch["doc"].to_numpy()[text], "digest": batch["digest"].to_numpy()[text],
                                    "line_no": number, "line": _line_ids(codes, start, size)})

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInPandas(work, f"doc {kind}, digest long, line_no int, line long")


def segment(size: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and size of the i-th of edits + 1 segments of lines of the given size; the later ones may be longer by one."""
    short, rest = size // (edits + 1), size % (edits + 1)
    late = edits + 1 - rest
    return i * short + np.maximum(0, i - late), short + (i >= late)


def segment_keys(hashes: LineHashes, sums, start, size, edits: int, least: int, most: int | None = None):
    """Pieces of (key, probe or not, number of the line): the filed segments and the probed substrings of each line.

    Lines of `least` to `most` code points file; longer ones only probe for lines that do.
    """
    line = np.arange(len(start))
    for i in range(edits + 1):
        for shorter in range(edits + 1):
            own = size - shorter
            files = (own >= least) & (own <= most) if most else own >= least
            at, n = segment(own, i, edits)
            name = mixed(own.astype(np.uint64) * np.uint64(64) + np.uint64(16 * edits + i))
            if not shorter:
                yield mixed(hashes.between(sums, (start + at)[files], n[files]) + name[files]).view(np.int64), False, line[files]
            # A segment moves by at most the edits before it, and by what the edits after it leave.
            for move in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                fits = files & (at + move >= 0) & (at + move + n <= size)
                a, m = (start + at + move)[fits], n[fits]
                yield mixed(hashes.between(sums, a, m) + name[fits]).view(np.int64), True, line[fits]


def _keys(docs: DataFrame, edits: int, least: int, short: bool) -> DataFrame:
    """Filed and probed keys of the lines from `least` code points on; with `short` also those of shorter lines."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = LineHashes()
        for batch in batches:
            seen: set[int] = set()
            for codes, _, _, start, size in _lines(batch["text"], least, short):
                some = size >= (ONE_EDIT_CHARS if short else least)
                ids, first = np.unique(_line_ids(codes, start[some], size[some]), return_index=True)
                new = np.array([x not in seen for x in ids.tolist()], bool)
                seen.update(ids.tolist())
                ids, start, size = ids[new], start[some][first][new], size[some][first][new]
                sums = hashes.of(codes)
                kinds = [(size >= least, edits, least, None)]
                if short:
                    kinds.append((size <= least, min(edits, 1), ONE_EDIT_CHARS, least - 1))
                for here, allowed, low, high in kinds:
                    parts = list(segment_keys(hashes, sums, start[here], size[here], allowed, low, high))
                    yield pd.DataFrame({
                        "key": np.concatenate([k for k, _, _ in parts]),
                        "probe": np.concatenate([np.full(len(k), p) for k, p, _ in parts]),
                        "line": np.concatenate([ids[here][x] for _, _, x in parts])})

    return docs.select("text").mapInPandas(work, "key long, probe boolean, line long")


def _meetings(keys: DataFrame) -> DataFrame:
    """The rows of keys that are filed and at which at least two lines stand.

    Partitions are sorted with filed rows first. A key waits only while one line stands at it.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wait, open_key = None, None  # rows of the last key so far; its number, if it is known to be a meeting or dead
        open_alive = False
        for batch in batches:
            rows = batch if wait is None else pd.concat([wait, batch], ignore_index=True)
            rows = rows[(rows != rows.shift()).any(axis=1)] if len(rows) else rows
            if not len(rows):
                continue
            key, probe, line = (rows[c].to_numpy() for c in ("key", "probe", "line"))
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.concatenate([begin, [len(key)]]))
            filed = ~probe[begin].astype(bool)
            alive = filed & (np.minimum.reduceat(line, begin) < np.maximum.reduceat(line, begin))
            if open_key is not None and key[0] == open_key:
                alive[0], filed[0] = open_alive, open_alive
            last = key[-1]
            keep = np.repeat(alive, size)
            undecided = filed[-1] and not alive[-1]
            wait = rows.iloc[begin[-1]:] if undecided else None
            open_key, open_alive = (None, False) if undecided else (last, bool(alive[-1]))
            yield rows[keep]

    ordered = keys.repartition("key").sortWithinPartitions("key", "probe", "line")
    return ordered.mapInPandas(work, keys.schema)


def banded_distances(one: list[np.ndarray], two: list[np.ndarray], edits: int) -> np.ndarray:
    """Edit distance of each pair, or more than `edits` where it is above. Sizes differ by at most `edits`.

    The 2 * edits + 1 diagonals around the main one are the bits of a word per pair; a step of the
    loop takes the next code point of all pairs.
    """
    k, pairs = edits, len(one)
    n, m = np.array([len(x) for x in one]), np.array([len(x) for x in two])
    width, longest = 2 * k + 1, int(m.max(initial=0))
    a = np.full((pairs, longest + 4 * k + 2), 0xFFFFFFFE, np.uint32)
    b = np.full((pairs, longest), 0xFFFFFFFF, np.uint32)
    for row, x, y in zip(range(pairs), one, two):
        a[row, k:k + len(x)] = x
        b[row, :len(y)] = y
    full, top = np.uint64((1 << width) - 1), np.uint64(2 * k)
    bit = np.uint64(1)
    up = np.full(pairs, full ^ np.uint64((1 << k) - 1), np.uint64)
    down = np.zeros(pairs, np.uint64)
    score = np.full(pairs, k, np.int64)
    result, live = np.full(pairs, k + 1, np.int64), np.arange(pairs)
    for i in range(longest):
        match = np.zeros(len(live), np.uint64)
        for t in range(width):
            match |= (a[:, i + t] == b[:, i]).astype(np.uint64) << np.uint64(t)
        zero = ((((match & up) + up) ^ up) | match | down) & full
        plus = (down | ~(zero | up)) & full
        minus = zero & up
        diagonal = i < n - k
        row = np.where(diagonal, 0, 2 * k - 1 - (i - (n - k)))
        level = np.maximum(row, 0).astype(np.uint64)
        along = ((plus >> level) & bit).astype(np.int64) - ((minus >> level) & bit).astype(np.int64)
        score += np.where(diagonal, 1 - ((zero >> top) & bit).astype(np.int64), np.where(i < m, along, 0))
        shifted = zero >> bit
        up = (minus | ~(shifted | plus)) & full
        down = shifted & plus
        if i % 32 == 31 or i == longest - 1:
            done = i + 1 >= m
            result[live[done]] = score[done]
            rest = ~done & (score <= k + m - (n - k))
            if not rest.any():
                break
            if not rest.all():
                a, b, up, down, score, n, m, live = (x[rest] for x in (a, b, up, down, score, n, m, live))
    return result


def _linked(lines: np.ndarray, texts: list[np.ndarray], a: np.ndarray, b: np.ndarray, edits: int,
            short: bool) -> Iterator[pd.DataFrame]:
    """Verify the pairs a-b of positions, and return for each linked line the smallest line of its component here."""
    if not len(a):
        return
    size = np.array([len(t) for t in texts])
    shorter = np.where(size[a] <= size[b], a, b)
    longer = np.where(size[a] <= size[b], b, a)
    order = np.argsort(size[longer], kind="stable")
    shorter, longer = shorter[order], longer[order]
    good = np.zeros(len(order), bool)
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * size[longer[end]] <= _PAIR_CELLS:
            end += 1
        found = banded_distances([texts[x] for x in shorter[at:end]], [texts[x] for x in longer[at:end]], edits)
        good[at:end] = found <= (np.where(size[shorter[at:end]] < LEAST_CHARS, min(edits, 1), edits) if short else edits)
        at = end
    x, y = shorter[good], longer[good]
    if len(x):
        names, place = np.unique(lines, return_inverse=True)
        label = np.arange(len(names))
        while True:
            low = np.minimum(label[place[x]], label[place[y]])
            new = label.copy()
            np.minimum.at(new, place[x], low)
            np.minimum.at(new, place[y], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        some = np.flatnonzero(label != np.arange(len(names)))
        yield pd.DataFrame({"a": names[some], "b": names[label[some]]})


def _verified(met: DataFrame, texts: DataFrame, edits: int, short: bool) -> DataFrame:
    """Links of lines that meet at a key, from blocks of the key. With `short`, lines below LEAST_CHARS may differ by one edit."""
    sizes = met.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("line", "key"), F.col("blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cut = (
        met.join(sizes, "key").join(texts, "line")
        .withColumn("i", F.explode(F.when(F.col("probe"), others).otherwise(F.array(own))))
        .withColumn("j", F.explode(F.when(F.col("probe"), F.array(own)).otherwise(others)))
        .select("key", "i", "j", "probe", "line", "text")
    )

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = (rows[["key", "i", "j"]] == rows[["key", "i", "j"]].iloc[-1]).all(axis=1) if len(rows) else []
            held = rows[last] if len(rows) else None
            if len(rows):
                yield from pairs(rows[~last])
        if held is not None:
            yield from pairs(held)

    def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        lines, probe = rows["line"].to_numpy(), rows["probe"].to_numpy().astype(bool)
        texts = [np.frombuffer(t.encode("utf-32-le"), dtype="<u4") for t in rows["text"]]
        size = np.array([len(t) for t in texts])
        a, b, waiting = [], [], 0
        for places in rows.reset_index(drop=True).groupby(["key", "i", "j"]).indices.values():
            there, coming = places[~probe[places]], places[probe[places]]
            x, y = np.repeat(coming, len(there)), np.tile(there, len(coming))
            near = (lines[x] != lines[y]) & (size[x] >= size[y]) & (size[x] - size[y] <= edits)
            near &= (size[x] != size[y]) | (lines[x] < lines[y])
            a.append(x[near])
            b.append(y[near])
            waiting += int(near.sum())
            if waiting > 100_000:
                yield from _linked(lines, texts, *_once(a, b, lines), edits, short)
                a, b, waiting = [], [], 0
        if waiting:
            yield from _linked(lines, texts, *_once(a, b, lines), edits, short)

    ordered = cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "probe")
    return ordered.mapInPandas(work, "a long, b long").distinct()


def _once(a: list[np.ndarray], b: list[np.ndarray], lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.concatenate(a), np.concatenate(b)
    _, first = np.unique(np.stack([lines[x], lines[y]]), axis=1, return_index=True)
    return x[first], y[first]


def repeated_lines(docs: DataFrame, edits: int = EDITS, least_chars: int | None = None) -> DataFrame:
    """Per row of `doc`, `digest`, `text` that loses lines: doc, digest, `gone`, the numbers of its lines to remove."""
    short, least_chars = least_chars is None, LEAST_CHARS if least_chars is None else least_chars
    seen = materialize(occurrences(docs, least_chars, short))
    met = materialize(_meetings(_keys(docs, edits, least_chars, short)))
    place = F.struct(F.col("doc").isNull().alias("missing"), "doc", "digest", "line_no")
    wanted = (
        seen.join(met.select("line").distinct(), "line", "left_semi").groupBy("line").agg(F.min(place).alias("p"))
        .groupBy("p.doc", "p.digest").agg(F.collect_list(F.struct("p.line_no", "line")).alias("wanted"))
    )
    holding = docs.alias("d").join(wanted.alias("w"), F.col("d.doc").eqNullSafe(F.col("w.doc")) & (F.col("d.digest") == F.col("w.digest")))
    texts = materialize(
        holding.select(F.split("d.text", "\n").alias("lines"), F.explode("w.wanted").alias("x"))
        .select("x.line", F.get("lines", F.col("x.line_no")).alias("text")).dropDuplicates(["line"]))
    links = materialize(_verified(met, texts, edits, short))
    groups = components(links).withColumnRenamed("node", "line")
    named = seen.join(groups, "line", "left").withColumn("class", F.coalesce("component", "line"))
    first = named.groupBy("class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = named.join(first, "class").where(place != F.col("first"))
    return later.groupBy("doc", "digest").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                           least_chars: int | None = None) -> DataFrame:
    """All columns of the input, its text without the repeated lines, and `__lines`, `__removed`.

    A given `least_chars` leaves lines below it alone; without, every line that is not blank is treated.
    """
    gone = repeated_lines(_keyed(docs, id_col, text_col), edits, least_chars)
    gone = gone.select(F.col("doc").alias("__doc"), F.col("digest").alias("__digest"), F.col("gone").alias("__gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    wide = docs.join(gone, F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__digest")), "left")
    lines = F.split(text, "\n")
    # The runs of lines between those that go, so that the work does not grow with lines times lines gone.
    bounds = F.concat(F.array(F.lit(-1)), F.col("__gone"), F.array(F.size(lines)))
    rest = let(lines, lambda x: let(bounds, lambda b: F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("__gone") + 1),
        lambda k: F.slice(x, F.get(b, k - 1) + 2, F.get(b, k) - F.get(b, k - 1) - 1))), "\n")))
    return wide.select(
        *[F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(rest).alias(c) if c == text_col else F.col(f"`{c}`")
          for c in docs.columns],
        F.size(lines).cast("long").alias("__lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("__removed"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """Documents without repeated lines; those of which no word is left go. `n_chars` follows the text."""
    found = without_repeated_lines(docs)
    left = (F.col("__removed") == 0) | (F.length(without(F.col("text"), GAPS)) > 0)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.where(left).select(*docs.columns)
