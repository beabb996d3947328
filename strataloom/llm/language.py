"""Language identification by a linear-chain conditional random field over the words of a text.

Words are runs of ASCII letters and other code points from U+0080 on, A-Z in lower case. The
potentials of a word come from its affixes, character n-grams and the lexicons of frequent words
in which it stands; a matrix of learned transitions links neighbours. Training chains are spliced
from spans of texts in different languages, so switches inside a text are learned, too. Forward-
backward runs over whole texts: these are cut into segments, the transfer matrix of each segment
is the product over its words, messages go from segment to segment by these products, and all
segments of a batch are then worked through side by side. The cut changes no result, and a long
text needs no long loop.

Defined results: a null text, or one without a letter, is `und` with score 0, as is every text
where nothing could be learned; words without known features take the language of their
neighbours; repeated rows are judged each on its own; a null id is kept; an empty table gives an
empty table; columns other than those named are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .quality import held_out
from .retrieval import texts_of

ROWS_PER_LANGUAGE = 250  # bounds of the sample that the field is fitted on:
MAX_ROWS = 6000  # rows by turns from all languages,
WORDS_PER_ROW = 64  # words in a row from a place that depends on the id
MAX_FEATURES = 60_000  # features seen in two sampled words or more, most frequent first
LEXICON = 400  # words of a lexicon
SLOT_BITS = 20
CHAIN = 64  # words of a training chain, and of a segment
SPANS = (2, 24)  # words of one language in a training chain
ROUNDS, RATE, SHRINK = 40, 0.3, 1e-4
BATCH_BYTES = 1 << 21  # whole texts that are worked out together
MAX_CACHED = 300_000  # words whose potentials a task remembers
LEAST_LOG, SCALED = -60.0, 4  # so many steps between two scalings stay far above the smallest number

#: Bytes outside words become blanks, A-Z become lower case; bytes of other code points stay.
_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_BYTES).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scrambling of 64-bit numbers that is no polynomial."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def features_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words and keys of their features, in any order.

    Features are letters, n-grams of two and three with the ends of the word, and the affixes of
    three and four letters (n-grams at an end).
    """
    text = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = text == 32
    word = np.cumsum(blank) - 1  # a blank belongs to the word after it
    rows, keys = [], []
    for width in range(1, 6):
        n = len(text) - width + 1
        key = np.full(max(n, 0), width, np.uint64)
        inside = np.ones(len(key), bool)
        for j in range(width):
            key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + text[j:j + n])
            if 0 < j < width - 1:
                inside &= ~blank[j:j + n]
        if width == 1:
            inside &= ~blank
        elif width > 3:
            inside &= blank[:n] ^ blank[width - 1:width - 1 + n]
        rows.append(word[min(width - 1, 1):][:n][inside] if width > 2 else word[:n][inside])
        keys.append(key[inside])
    return np.concatenate(rows), np.concatenate(keys)


@dataclass
class LanguageField:
    """Languages, keys of features, weights, lexicons (word to rows of weights) and log transitions.

    Rows of the weights: one that all words share, the features, one per lexicon.
    """

    languages: list[str]
    keys: np.ndarray
    weights: np.ndarray
    lexicons: dict[str, list[int]]
    transitions: np.ndarray

    def __post_init__(self):
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)  # rows of features by the first bits of their keys
        self.slots[self.keys >> np.uint64(64 - SLOT_BITS)] = np.arange(1, len(self.keys) + 1)

    def places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the weights for all words, one word after another, and where each word's begin."""
        row, key = features_of(words)
        at = self.slots[key >> np.uint64(64 - SLOT_BITS)]
        known = np.flatnonzero(at)
        known = known[self.keys[at[known] - 1] == key[known]]
        listed = [(i, place) for i, w in enumerate(words) for place in self.lexicons.get(w, ())]
        rows = np.concatenate([np.arange(len(words)), row[known], np.array([i for i, _ in listed], np.int64)])
        places = np.concatenate([np.zeros(len(words), np.int64), at[known], np.array([x for _, x in listed], np.int64)])
        order = np.argsort(rows, kind="stable")
        return places[order], np.searchsorted(rows[order], np.arange(len(words)))

    def potentials(self, words: list[str]) -> np.ndarray:
        """Per word, the potential of each language, 1 for the likeliest."""
        places, first = self.places(words)
        return _softened(np.add.reduceat(self.weights[places], first, axis=0))

    def transfer(self) -> np.ndarray:
        k = len(self.languages)
        return _softened(self.transitions.reshape(1, -1)).reshape(k, k) if k else self.transitions


def _softened(logs: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(logs - logs.max(axis=1, keepdims=True), LEAST_LOG))


def _scaled(x: np.ndarray, axes=0) -> np.ndarray:
    return x / x.sum(axis=axes, keepdims=True)


def marginals(potentials: np.ndarray, lengths: np.ndarray, transfer: np.ndarray, pairs: bool = False):
    """Forward-backward over chains that lie one after another in `potentials` (languages x words).

    Before the first word of a chain all languages are equally likely. Returns the probability of
    each language for each word and, with `pairs`, the expected transitions inside segments.
    """
    k = len(transfer)
    pieces = -(-lengths // CHAIN)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)  # of the segment in its chain
    start = np.repeat(np.cumsum(lengths) - lengths, pieces) + number * CHAIN
    size = np.minimum(CHAIN, np.repeat(lengths, pieces) - number * CHAIN)
    order = np.argsort(-size, kind="stable")  # segments that still run at a step stand first
    start, size, rank, total = start[order], size[order], np.argsort(order), len(order)
    steps = range(int(size.max(initial=0)))
    running = [int(np.searchsorted(-size, -t, side="left")) for t in steps]
    word = np.minimum(start + np.arange(len(steps))[:, None], potentials.shape[1] - 1)
    given = potentials[:, word]

    into, out = np.full((k, total), 1 / k), np.full((k, total), 1 / k)  # messages from the left and from the right
    if pieces.max(initial=0) > 1:
        product = np.broadcast_to(np.eye(k)[:, :, None], (k, k, total)).copy()  # from, to, segment
        for t, c in enumerate(running):
            step = np.matmul(transfer.T, product[:, :, :c]) * given[None, :, t, :c]
            product[:, :, :c] = _scaled(step, (0, 1)) if t % SCALED == 0 else step
        product = _scaled(product, (0, 1))
        first = np.cumsum(pieces) - pieces
        by_pieces = np.argsort(-pieces, kind="stable")
        for j in range(1, int(pieces.max())):
            some = by_pieces[:int(np.searchsorted(-pieces[by_pieces], -j, side="left"))]  # chains with more than j segments
            here, before = rank[first[some] + j], rank[first[some] + j - 1]
            into[:, here] = _scaled(np.einsum("in,ijn->jn", into[:, before], product[:, :, before]))
            last, after = rank[first[some] + pieces[some] - 1 - j], rank[first[some] + pieces[some] - j]
            out[:, last] = _scaled(np.einsum("ijn,jn->in", product[:, :, after], out[:, after]))

    forward = np.empty_like(given)
    message = into
    for t, c in enumerate(running):
        message = (transfer.T @ message[:, :c]) * given[:, t, :c]
        if t % SCALED == 0:
            message = _scaled(message)
        forward[:, t, :c] = message
    expected, message = np.zeros((k, k)), out
    for t in reversed(steps):
        c = running[t]
        right = given[:, t, :c] * message[:, :c]
        if pairs and t:
            pair = forward[:, None, t - 1, :c] * transfer[:, :, None] * right[None]
            expected += _scaled(pair, (0, 1)).sum(axis=2)
        forward[:, t, :c] *= message[:, :c]
        right = transfer @ right
        message[:, :c] = _scaled(right) if t % SCALED == 0 else right
    place = np.empty(potentials.shape[1], np.int64)
    valid = np.arange(len(steps))[:, None] < size
    place[word[valid]] = np.flatnonzero(valid)
    found = _scaled(forward.reshape(k, -1)[:, place])
    return (found, expected) if pairs else found


def _spliced(rows: list[tuple[int, list[str]]], rng) -> tuple[list[str], np.ndarray]:
    """Words and languages of chains made of spans from all rows, in mixed order."""
    spans = []
    for language, words in rows:
        at = 0
        while at < len(words):
            n = int(rng.integers(*SPANS, endpoint=True))
            spans.append((language, words[at:at + n]))
            at += n
    rng.shuffle(spans)
    words = [w for _, span in spans for w in span]
    labels = np.array([language for language, span in spans for _ in span], np.int64)
    whole = len(words) // CHAIN * CHAIN or len(words)  # a shorter rest would be no chain
    return words[:whole], labels[:whole]


def fit_field(rows: list[tuple[str, list[str]]], seed: int = 13) -> LanguageField:
    """The field of largest likelihood on chains spliced from `rows` (language, words)."""
    rows = sorted(r for r in rows if r[1])
    languages = sorted({name for name, _ in rows})
    place = {name: i for i, name in enumerate(languages)}
    k = len(languages)
    if not k:
        return LanguageField([], np.zeros(0, np.uint64), np.zeros((1, 0)), {}, np.zeros((0, 0)))
    frequent = {name: Counter() for name in languages}
    for name, words in rows:
        frequent[name].update(words)
    known = sorted({w for c in frequent.values() for w in c})
    row, key = features_of(known)
    pairs = np.unique(np.stack([key, row.astype(np.uint64)]), axis=1)[0]
    found, holders = np.unique(pairs, return_counts=True)
    chosen = np.lexsort((found, -holders))[:MAX_FEATURES]
    keys = found[chosen][holders[chosen] > 1]
    keys = keys[np.sort(np.unique(keys >> np.uint64(64 - SLOT_BITS), return_index=True)[1])]  # one feature a slot
    lexicons: dict[str, list[int]] = {}
    for i, name in enumerate(languages):
        for w in sorted(frequent[name], key=lambda w: (-frequent[name][w], w))[:LEXICON]:
            lexicons.setdefault(w, []).append(1 + len(keys) + i)
    field = LanguageField(languages, keys, np.zeros((1 + len(keys) + k, k)), lexicons, np.zeros((k, k)))

    words, labels = _spliced([(place[name], own) for name, own in rows], np.random.default_rng(seed))
    used = {w: i for i, w in enumerate(sorted(set(words)))}
    ids = np.array([used[w] for w in words])
    places, first = field.places(list(used))
    of_word = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(places))))
    by_place = np.argsort(places, kind="stable")
    seen, begins = np.unique(places[by_place], return_index=True)
    by_id = np.argsort(ids, kind="stable")
    id_begins = np.searchsorted(ids[by_id], np.arange(len(used)))
    chains = max(1, len(words) // CHAIN)
    lengths = np.full(chains, len(words) // chains)
    truth = np.zeros((len(words), k))
    truth[np.arange(len(words)), labels] = 1.0
    after = np.arange(len(words)) % lengths[0] > 0
    pairs = np.zeros((k, k))
    np.add.at(pairs, (labels[:-1][after[1:]], labels[1:][after[1:]]), 1.0)

    parameters = [field.weights, field.transitions]
    means, squares = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, ROUNDS + 1):
        potentials = _softened(np.add.reduceat(field.weights[places], first, axis=0))[ids]
        likely, expected = marginals(potentials.T, lengths, field.transfer(), pairs=True)
        miss = truth - likely.T
        by_word = np.add.reduceat(miss[by_id], id_begins, axis=0)
        by_feature = np.zeros_like(field.weights)
        by_feature[seen] = np.add.reduceat(by_word[of_word[by_place]], begins, axis=0)
        slopes = [by_feature / len(words) - SHRINK * field.weights / len(field.weights),
                  (pairs - expected) / len(words) - SHRINK * field.transitions]
        for p, slope, mean, square in zip(parameters, slopes, means, squares):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            p += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return field


def learn_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageField:
    """Fit on rows with a language that are not held out: the smallest id hashes of each language, by turns.

    At most `MAX_ROWS` rows of `WORDS_PER_ROW` words come to the driver.
    """
    labelled = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang")).where(
        F.col("__id").isNotNull() & F.col("__lang").isNotNull() & ~held_out(F.col("__id")))
    key = F.xxhash64("__id")
    for part in (["__lang", F.pmod(key, F.lit(64))], ["__lang"]):  # in two steps, as a language may hold most rows
        turn = F.row_number().over(W.partitionBy(*part).orderBy(key, "__id"))
        labelled = labelled.withColumn("__turn", turn).where(F.col("__turn") <= ROWS_PER_LANGUAGE)
    sample = labelled.orderBy(
        "__turn", key, "__id", "__lang").limit(MAX_ROWS).select("__id", "__lang").distinct()
    texts = docs.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"))

    def window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for raw in texts_of(batch.column(1)):
                words = words_of(raw)
                at = zlib.crc32(raw) % max(1, len(words) - WORDS_PER_ROW + 1)
                kept.append(b" ".join(words[at:at + WORDS_PER_ROW]).decode().lower())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], ["lang", "words"])

    # A limit on the rows, too, for ids that many rows share.
    rows = texts.join(F.broadcast(sample), ["__id", "__lang"]).select("__lang", "__text").mapInArrow(
        window, "lang string, words string").orderBy(F.xxhash64("words"), "words", "lang").limit(2 * MAX_ROWS)
    return fit_field([(r["lang"], r["words"].split(" ")) for r in rows.collect() if r["words"]])


def _words(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in texts that lie one after another, cut at `borders`."""
    inside = data != 32
    edge = np.zeros(len(data) + 1, bool)
    edge[borders] = True
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def _names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A scrambled 64-bit number of the bytes of each word, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = ends - starts
    name = size.astype(np.uint64)
    some, at = np.arange(len(starts)), 0
    while len(some):
        left = np.minimum(size[some] - at, 8).astype(np.uint64)
        part = eight[starts[some] + at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))
        name[some] = _mixed(name[some] * np.uint64(0x9E3779B97F4A7C15) + part)
        at += 8
        some = some[size[some] > at]
    return name


class _Potentials:
    """Potentials of words by name, worked out once per task for each word as long as they are few."""

    def __init__(self, field: LanguageField):
        self.field = field
        self._clear()

    def _clear(self) -> None:
        self.names, self.letters = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.table = np.zeros((0, len(self.field.languages)))

    def of(self, names: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per different word of a batch, its potentials and whether it holds a letter; names in ascending order."""
        if len(self.names) > MAX_CACHED:
            self._clear()
        at = np.searchsorted(self.names, names)
        known = np.zeros(len(names), bool)
        within = at < len(self.names)
        known[within] = self.names[at[within]] == names[within]
        new = np.flatnonzero(~known)
        if len(new):
            words = b" ".join([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]).decode().lower().split(" ")
            letters = np.array([w.isascii() or any(map(str.isalpha, w)) for w in words], bool)
            self.table = np.insert(self.table, at[new], self.field.potentials(words), axis=0)
            self.letters = np.insert(self.letters, at[new], letters)
            self.names = np.insert(self.names, at[new], names[new])
            at = np.searchsorted(self.names, names)
        return self.table[at], self.letters[at]


def _judged(raw: bytes, borders: np.ndarray, cache: _Potentials, transfer: np.ndarray, runs: bool):
    """Per text: place of its language or -1, score, and runs (first word, words, place of language)."""
    n_texts = len(borders) - 1
    best, score, spans = np.full(n_texts, -1), np.zeros(n_texts), [[] for _ in range(n_texts)]
    raw = raw.translate(_BYTES)
    data = np.frombuffer(raw, np.uint8)
    starts, ends = _words(data, borders)
    if not len(starts) or not len(transfer):
        return best, score, spans
    names, one, ids = np.unique(_names(data, starts, ends), return_index=True, return_inverse=True)
    table, letters = cache.of(names, raw, starts[one], ends[one])
    lengths = np.bincount(np.searchsorted(borders, starts, side="right") - 1, minlength=n_texts)
    some = np.flatnonzero(lengths)
    likely = marginals(np.take(table.T, ids, axis=1), lengths[some], transfer)
    first = np.cumsum(lengths[some]) - lengths[some]
    shares = np.round(np.add.reduceat(likely, first, axis=1) / lengths[some], 9)  # sums differ in the last bits with the batch
    has_letter = np.add.reduceat(letters[ids].astype(np.int64), first) > 0
    best[some] = np.where(has_letter, shares.argmax(axis=0), -1)
    score[some] = np.where(has_letter, np.minimum(shares.max(axis=0), 1.0), 0.0)
    if runs:
        label = likely.argmax(axis=0)
        for i, a, n, lettered in zip(some, first, lengths[some], has_letter):
            if lettered:
                own = label[a:a + n]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [n]])
                spans[i] = [{"first": int(x), "n_words": int(y - x), "lang": cache.field.languages[own[x]]}
                            for x, y in zip(cuts[:-1], cuts[1:])]
    return best, score, spans


def identify(docs: DataFrame, field: LanguageField, id_col: str = "doc_id", text_col: str = "text", runs: bool = False) -> DataFrame:
    """Per document its id, `lang_pred` and `score`, the expected share of its words in that language.

    With `runs`, also the runs of neighbouring words of one language, in order: first word from 0,
    number of words, language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded by MAX_FEATURES and the languages
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        transfer, cache = field.transfer(), _Potentials(field)
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_binary())
            places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = memoryview(texts.buffers()[2] or b"")
            at = 0
            while at < len(batch):  # whole texts, as many as fit
                to = max(at + 1, int(np.searchsorted(places, places[at] + BATCH_BYTES, side="right")) - 1)
                best, score, spans = _judged(bytes(data[places[at]:places[to]]), places[at:to + 1] - places[at], cache, transfer, runs)
                names = [field.languages[b] if b >= 0 else "und" for b in best]
                columns = [batch.column(0).slice(at, to - at), pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(spans, kinds)] if runs else []), head)
                at = to

    head = [id_col, "lang_pred", "score", *(["runs"] if runs else [])]
    kinds = pa.list_(pa.struct([("first", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))
    schema = f"`{id_col}` {kind}, lang_pred string, score double"
    if runs:
        schema += ", runs array<struct<first: bigint, n_words: bigint, lang: string>>"
    return docs.select(id_col, text_col).mapInArrow(judge, schema)
