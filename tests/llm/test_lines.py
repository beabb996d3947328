"""Line removal against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import lines as L


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def changed(r, text, n):
    out = list(text)
    for _ in range(n):
        what, at = r.random(), r.randrange(len(out) + 1)
        if what < 0.33:
            out.insert(at, r.choice("abé😀"))
        elif what < 0.66 and at < len(out):
            out.pop(at)
        elif at < len(out):
            out[at] = r.choice("abcé")
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_is_the_edit_distance_up_to_the_threshold(edits):
    r = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abc") for _ in range(r.randint(6, 60)))
        b = changed(r, a, r.randint(0, edits + 2))
        if abs(len(a) - len(b)) <= edits:
            pairs.append(sorted((a, b), key=len))
    codes = [[np.array(list(map(ord, x)), np.uint32) for x in side] for side in zip(*pairs)]
    got = L.banded_distances(codes[0], codes[1], edits)
    want = np.array([distance(a, b) for a, b in pairs])
    assert (np.minimum(got, edits + 1) == np.minimum(want, edits + 1)).all()


def brute(rows, edits, least):
    places = [(i is None, i if i is not None else 0, t, k, line) for i, t in sorted(
        set((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, x[0] or 0)) for k, line in enumerate(t.split("\n"))]
    long = [p for p in places if len(p[4]) >= least]
    names = sorted({p[4] for p in long})
    group = {x: x for x in names}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in names:
        for b in names:
            if a < b and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                group[root(a)] = root(b)
    seen, gone = set(), {}
    for missing, i, t, k, line in long:
        if root(line) in seen:
            gone.setdefault((None if missing else i, t), set()).add(k)
        seen.add(root(line))
    return sorted(((i, "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone.get((i, t or ""), ())))
                   for i, t in rows), key=str)


def test_equals_brute_force_in_small_batches(spark):
    r = random.Random(7)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(4, 40))) for _ in range(25)]
    rows = []
    for i in range(60):
        text = "\n".join(changed(r, r.choice(base), r.choice([0, 0, 1, 2, 3])) for _ in range(r.randint(0, 5)))
        rows.append((i, text))
    rows += [(None, rows[3][1]), (70, None), (71, ""), (72, rows[5][1]), (72, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = L.without_repeated_lines(df, edits=2, least_chars=8).select("doc_id", F.coalesce("text", F.lit(""))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(((a, b) for a, b in got), key=str) == brute(rows, 2, 8)


def brute_by_length(rows):
    """With production parameters: two edits from 24 code points on, one from 12 on, else none; the shorter line counts."""
    def edits(line):
        return 2 if len(line) >= 24 else 1 if len(line) >= 12 else 0

    keys = sorted(set((i, t) for i, t in rows))
    names = sorted({x for _, t in keys for x in t.split("\n") if len(x) >= 24 or x.strip(" \t\x0b\x0c\r")})
    group = {x: x for x in names}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in names:
        for b in names:
            most = min(edits(a), edits(b))
            if a < b and abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                group[root(a)] = root(b)
    seen, out = set(), {}
    for i, t in keys:
        kept = []
        for x in t.split("\n"):
            if x not in group or root(x) not in seen:
                kept.append(x)
            if x in group:
                seen.add(root(x))
        out[i, t] = "\n".join(kept)
    return sorted((i, out[i, t]) for i, t in rows)


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_short_lines_equal_brute_force_with_production_parameters(spark, batch):
    r = random.Random(11)
    base = ["".join(r.choice("abé😀 ") for _ in range(n)) for n in (1, 2, 5, 9, 10, 11, 12, 13, 14, 18, 22, 23, 24, 25, 26, 30)]
    base += ["aaaaaaaaaaaa", "abababababab", "", " ", " \t\r", "x" * 23]
    rows = []
    for i in range(160):
        rows.append((i, "\n".join(changed(r, r.choice(base) or "", r.choice([0, 0, 1, 1, 2])) for _ in range(r.randint(0, 6)))))
    rows += [(200, "\n".join(base)), (201, "\n".join(base)), (201, "\n".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = L.without_repeated_lines(df).select("doc_id", "text").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((a, b) for a, b in got) == brute_by_length(rows)


def test_blocks_give_the_same_links(spark, monkeypatch):
    r = random.Random(3)
    line = "".join(r.choice("abcdefgh ") for _ in range(60))
    rows = [(i, changed(r, line, 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(L, "BLOCK", 5)
    left = [x["text"] for x in L.without_repeated_lines(df).collect() if x["text"]]
    assert len(left) == 1


def test_stage_keeps_columns_and_drops_only_emptied_documents(spark):
    line = "a line of more than thirty characters, repeated"
    rows = [(1, line, "en", 3, "x"), (2, line, "en", 3, "x"), (3, line + "!\nand another line that is long enough", None, 3, "x"),
            (4, "", "en", 0, "x"), (5, None, "en", None, "x"), (None, "short", None, 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, line string")
    got = L.drop_repeated_lines(df)
    assert got.columns == df.columns
    kept = {x["doc_id"]: (x["text"], x["n_chars"]) for x in got.collect()}
    assert kept == {1: (line, 3), 3: ("and another line that is long enough", 36), 4: ("", 0), 5: (None, None), None: ("short", 5)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.without_repeated_lines(df).count() == 0


def thue_morse(doublings):
    """Two texts that differ in every place and that polynomial hashes modulo 2^64 cannot tell apart."""
    text = "a"
    for _ in range(doublings):
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


def test_lines_that_collide_under_polynomial_hashes_stay(spark):
    one, two = thue_morse(10)
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in L.without_repeated_lines(df).collect()}
    assert got == {1: one, 2: two, 3: ""}


def test_segments_of_short_lines_meet_within_one_edit():
    r = random.Random(5)
    hashes = L.LineHashes()

    def keys(text):
        codes = np.array(list(map(ord, text)), np.uint32)
        parts = list(L.segment_keys(hashes, hashes.of(codes), np.array([0]), np.array([len(codes)]), 1, 12, 23))
        return ({int(x) for k, p, _ in parts if not p for x in k}, {int(x) for k, p, _ in parts if p for x in k})

    for _ in range(500):
        a = "".join(r.choice("ab") for _ in range(r.randint(12, 23)))
        b = changed(r, a, 1)
        if len(b) < 12:
            continue
        a, b = sorted((a, b), key=len)
        assert keys(a)[0] & keys(b)[1]
        assert len(keys(a)[0]) <= 2 and len(keys(b)[1]) <= 4
