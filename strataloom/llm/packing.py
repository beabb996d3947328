"""Packing of tokenized documents into sequences of a fixed size by best-two-fit.

A sequence is filled greedily with the longest pieces that fit; then its smallest piece gives way
to the two unpacked pieces that fill the widened gap most tightly, where two do better. Which
lengths go together depends on lengths alone, so this is worked out on counts per length, at most
one row per token of a sequence, whatever the number of pieces; a sequence that can be repeated
as long as all its lengths last is repeated at once. Pieces then find their places by their rank
among pieces of the same length, in parallel; a length held by many pieces is ranked in parts.

Defined results: a null or empty text is one piece that holds only the end id; repeated rows are
packed each on its own; a null id is kept; an empty table gives an empty table; columns other than
the id and the text are not read. Only documents longer than a sequence are cut.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

CAPACITY = 4096
RANKED_TOGETHER = 4_000

MOST_KNOWN = 1_000_000

_TAIL = ".,!?;:&%$#*|"
_GAPS = re.compile(r"[\x20\x09-\x0D]+")
_ODD = re.compile(r"[\x1c-\x1f]")  # gaps for str.split, but not for tokenizers
# The units of WORD_SPLIT in UTF-8, where all that is not ASCII consists of letters.
_UNITS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")


# How a vocabulary file must treat text, so that its words can be encoded apart.
WORD_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORD_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def words_stand_alone(vocabulary: str) -> bool:
    """True if the file lowers letters, splits at gaps and punctuation, and closes every word, as `WordIds` presumes."""
    file = json.loads(vocabulary)
    normalizer, splitter = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}
    return (
        normalizer.get("normalizers") == WORD_NORMALIZERS
        and (splitter.get("pretokenizers") or [None])[0] == WORD_SPLIT
        and file["model"].get("end_of_word_suffix") == "</w>"
        and file.get("post_processor") is None
        and not file.get("truncation")
    )


class TextIds:
    """Token ids of whole texts as bytes, for any vocabulary file."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_str(vocabulary)
        self.encoder.no_truncation()
        self.encoder.no_padding()

    def of(self, texts: list[str]) -> Iterator[bytes]:
        for found in self.encoder.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(found.ids, dtype="<u4").tobytes()


class WordIds:
    """Token ids of whole texts as bytes, from units (words, digits, punctuation) that are encoded once, most of them in one go.

    A text in which characters beyond ASCII are not letters in composed form is cut at gaps only, and
    a word of it without its closing punctuation is encoded once.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        if not words_stand_alone(vocabulary):
            raise ValueError("the tokenizer does not encode words apart, give its whole texts to TextIds")
        self.encoder = Tokenizer.from_str(vocabulary)
        entries = self.encoder.get_vocab()
        self.closes = np.zeros(max(entries.values(), default=0) + 1, bool)
        self.closes[[i for token, i in entries.items() if token.endswith("</w>")]] = True
        self.units: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def of(self, texts: list[str]) -> Iterator[bytes]:
        units = [_UNITS.findall(t.encode().lower()) for t in texts]
        odd = self.learn_units(set().union(*units))
        apart = [not odd or odd.isdisjoint(u) for u in units]
        others = self.of_words([t for t, plain in zip(texts, apart) if not plain])
        look = self.units.__getitem__
        for some, plain in zip(units, apart):
            yield b"".join(map(look, some)) if plain else next(others)

    def learn_units(self, units: set[bytes]) -> set[bytes]:
        """Encode new units; those that are no unit of the tokenizer for certain are returned."""
        if len(self.units) > MOST_KNOWN:  # bounds the memory of a task; known units are only a cache
            self.units.clear()
        letters, signs, odd = {}, {}, set()
        for unit in units.difference(self.units):
            if unit.isalpha():
                letters[unit.decode()] = unit
            elif unit.isascii():
                signs[unit.decode()] = unit
            else:
                text = unit.decode()
                if text.isalpha() and text.lower().isalpha() and is_normalized("NFC", text):
                    letters[text] = unit
                else:
                    odd.add(unit)
        for named, found in ((letters, self._letters(sorted(letters))), (signs, self._apart(list(signs)))):
            self.units.update((named[text], ids) for text, ids in found)
        return odd

    def of_words(self, texts: list[str]) -> Iterator[bytes]:
        words = [list(filter(None, _GAPS.split(t))) if _ODD.search(t) else t.split() for t in texts]
        self.learn(set().union(*words))
        look = self.words.__getitem__
        for some in words:
            yield b"".join(map(look, some))

    def learn(self, words: set[str]) -> None:
        if len(self.words) > MOST_KNOWN:  # bounds the memory of a task; known words are only a cache
            self.words.clear()
            self.parts = {"": b""}
        new = words.difference(self.words)
        split = {}
        for word in new:
            part = word.rstrip(_TAIL)
            if part[-1:].isalpha() and len(part[-1].lower()) == 1:
                split[word] = (part.lower() if part.isascii() else part, word[len(part):])
            else:
                split[word] = (word, "")
        self._encode({x for pair in split.values() for x in pair}.difference(self.parts))
        parts = self.parts
        for word, (part, tail) in split.items():
            self.words[word] = parts[part] + parts[tail] if tail else parts[part]

    def _encode(self, parts: set[str]) -> None:
        letters = sorted(x for x in parts if x.isalpha() and x.lower().isalpha() and is_normalized("NFC", x))
        self.parts.update(self._letters(letters))
        self.parts.update(self._apart([x for x in parts if x not in self.parts]))

    def _letters(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters are one unit of the tokenizer each, which ends with a closing token."""
        for at in range(0, len(words), 20_000):
            some = words[at:at + 20_000]
            lines = [" ".join(some[k:k + 50]) for k in range(0, len(some), 50)]
            ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in self.encoder.encode_batch_fast(lines, add_special_tokens=False)])
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                yield from self._apart(some)
                continue
            raw = ids.tobytes()
            start = 0
            for word, end in zip(some, (4 * ends).tolist()):
                yield word, raw[start:end]
                start = end

    def _apart(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(parts), 10_000):
            some = parts[at:at + 10_000]
            for part, found in zip(some, self.encoder.encode_batch_fast(some, add_special_tokens=False)):
                yield part, np.array(found.ids, dtype="<u4").tobytes()


def _spans(texts, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive texts of together about `most` characters."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size > most:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                     id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Pieces of at most `capacity` token ids: id, `piece`, `start`, `length`, `ids_crc32` and, if wanted, `ids`.

    `tokenizer` is the path of a `tokenizers` file on the driver, whose content (a vocabulary, of
    fixed size) is sent to the executors. Where its words end at white space and before punctuation,
    parts of words are encoded once and put together; with any other file whole texts are encoded.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    apart = words_stand_alone(content)
    shared = spark.sparkContext.broadcast({"vocabulary": content})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = shared.value  # stays in the worker's process: the next task there finds the encoder and the words it knows
        if "encoder" not in kept:
            kept["encoder"] = (WordIds if apart else TextIds)(kept["vocabulary"])
        text_ids = kept["encoder"]
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys, texts = batch["__id"].tolist(), batch["__text"].tolist()
            for a, b in _spans(texts):
                rows = []
                for key, found in zip(keys[a:b], text_ids.of(texts[a:b])):
                    ids = found + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        body = ids[at:at + 4 * capacity]
                        row = (key, piece, at // 4, len(body) // 4, zlib.crc32(body))
                        rows.append((*row, np.frombuffer(body, dtype="<u4").astype(np.int32)) if keep_ids else row)
                yield pd.DataFrame(rows, columns=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"__id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return texts.mapInPandas(cut, schema).withColumnRenamed("__id", id_col)


class _Stock:
    """Counts per length, with the longest length in stock up to a limit found quickly."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.lengths = sorted(counts)

    def longest(self, limit: int) -> int | None:
        at = bisect_right(self.lengths, limit)
        return self.lengths[at - 1] if at else None

    def take(self, length: int, n: int = 1) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            self.lengths.remove(length)

    def give(self, length: int) -> None:
        if not self.counts[length]:
            self.lengths.insert(bisect_right(self.lengths, length), length)
        self.counts[length] += 1

    def best_two(self, limit: int) -> tuple[int, int] | None:
        """Two lengths in stock with the largest sum up to `limit`."""
        best, pair = 0, None
        low, high = 0, bisect_right(self.lengths, limit) - 1
        while low <= high:
            a, b = self.lengths[low], self.lengths[high]
            if a + b > limit:
                high -= 1
            elif low == high and self.counts[a] < 2:
                break
            else:
                if a + b > best:
                    best, pair = a + b, (b, a)
                    if best == limit:
                        break
                low += 1
        return pair


def sequence_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Lengths that go together in one sequence, longest first, and how many such sequences there are."""
    stock, out = _Stock({k: v for k, v in counts.items() if v}), []
    while stock.lengths:
        chosen, gap = [], capacity
        while (length := stock.longest(gap)) is not None:
            stock.take(length)
            chosen.append(length)
            gap -= length
        smallest = chosen[-1]
        if gap and len(chosen) > 1:
            stock.give(smallest)
            pair = stock.best_two(gap + smallest)
            stock.take(smallest)
            if pair and sum(pair) > smallest and smallest not in pair:
                stock.give(smallest)
                for length in pair:
                    stock.take(length)
                chosen = sorted([*chosen[:-1], *pair], reverse=True)
        uses = {x: chosen.count(x) for x in chosen}
        more = min(stock.counts[x] // n for x, n in uses.items())
        if more:
            for x, n in uses.items():
                stock.take(x, n * more)
        out.append((chosen, 1 + more))
    return out


def placed(pieces: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces with a `length` of 1 to `capacity`; `pieces` is a written table."""
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = sequence_patterns(sizes, capacity)  # at most `capacity` lengths

    # Per length, the ranks from which a pattern takes its pieces, and where they stand in it.
    used = dict.fromkeys(sizes, 0)
    first_sequence = 0
    plan: dict[int, list[tuple[int, int, int, int]]] = {x: [] for x in sizes}
    for chosen, times in patterns:
        offset = 0
        for length in dict.fromkeys(chosen):
            n = chosen.count(length)
            plan[length].append((used[length], n, offset, first_sequence))
            used[length] += n * times
            offset += n * length
        first_sequence += times
    lookup = {x: np.array(rows, dtype=np.int64) for x, rows in plan.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            rank = batch["__rank"].to_numpy()
            for length, rows in batch.groupby("length").indices.items():
                table = lookup[length]
                row = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                past = rank[rows] - row[:, 0]
                sequence[rows] = row[:, 3] + past // row[:, 1]
                offset[rows] = row[:, 2] + past % row[:, 1] * length
            yield batch.drop(columns="__rank").assign(sequence_id=sequence, offset=offset)

    total = sum(sizes.values())
    ranked = _ranks(pieces, id_col, max(1, -(-total // RANKED_TOGETHER)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, f"{kinds}, sequence_id long, offset long")


def _ranks(pieces: DataFrame, id_col: str, parts: int) -> DataFrame:
    """The rank of each piece among those of its length, from 0: within parts by a hash, parts one after another."""
    part = F.pmod(F.xxhash64(F.col(id_col), "piece"), F.lit(parts))
    cut = pieces.withColumn("__part", part)
    sizes = cut.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("length", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # Rows that share an id are told apart by the digest of their ids.
    within = W.partitionBy("length", "__part").orderBy(id_col, "piece", *[c for c in ("ids_crc32",) if c in pieces.columns])
    ranked = cut.withColumn("__within", F.row_number().over(within) - 1).join(starts, ["length", "__part"])
    return ranked.select(*pieces.columns, (F.col("__before") + F.col("__within")).alias("__rank"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Tokenize, cut and place whole documents."""
    pieces = materialize(tokenized_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, keep_ids))
    return placed(pieces, id_col, capacity)
