"""The prefix trie against plain sets of prefixes, with short layers and many ranges, and the query's rebuilding."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strataloom.llm import prefixes, queries_prefixes

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(conversations):
    """Nodes of {id: [(role, text), ...]}."""
    members = {}
    for i, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(i)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:-1] == p] for p in members}

    def below(p):
        return [q for q in members if q[:len(p)] == p]

    out = []
    for p, ids in members.items():
        ends = ",".join(str(i) for i in sorted(ids) if len(conversations[i]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]),
                    sum(not children[q] for q in below(p)),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below(p) if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    """Conversations of rows (conv_id, turn, role, text)."""
    out = {}
    for i, turn, role, text in rows:
        if i is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out.setdefault(i, []).append((turn is not None, turn or 0, tie, role, text))
    return {i: [(r, t) for *_, r, t in sorted(turns)] for i, turns in out.items()}


def rows_of(seed):
    r = random.Random(seed)
    rows = []
    for i in range(-6, 60):
        for k in range(r.randint(1, 9)):
            rows.append((i, k if r.random() < 0.9 else None, r.choice(["user", "assistant", None]), r.choice(["é", "aa", "", None, "b" * 9])))
    rows += [(100 + i, k, "user", "copied") for i in range(40) for k in range(5)]
    rows += [(200 + i, k, "user", f"deep {k}") for i in range(3) for k in range(17 + 4 * i)] + [(300, 0, "a", "b"), (300, 0, "a", "b")]
    rows += [(None, 0, "user", "lost")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, b"x") for r in rows], SCHEMA + ", depth int, key binary").repartition(parts)


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.mark.parametrize("layer, parts", [(256, "4"), (5, "7"), (1, "2")])
def test_trie_equals_sets_of_prefixes(spark, monkeypatch, layer, parts):
    monkeypatch.setattr(prefixes, "LAYER", layer)
    monkeypatch.setattr(prefixes, "CHUNK", 7)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [r for r in rows_of(1) if layer > 2 or r[0] is None or r[0] < 12 and (r[1] or 0) < 4]
        assert result(prefixes.conversation_trie(frame(spark, rows))) == brute(ordered(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rebuilt_conversations(spark):
    rows = rows_of(2)
    own, rebuilt = ordered(rows), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(head, [])[:h] + own[c][h:]
    turns = prefixes.number_turns(prefixes.digest_turns(frame(spark, rows)))
    got = prefixes.prefix_nodes(*queries_prefixes.with_shared_heads(turns))
    assert result(got) == brute(rebuilt)


def test_conversations_without_turns_and_empty_tables(spark):
    turns = prefixes.number_turns(prefixes.digest_turns(frame(spark, [(5, 0, "a", "b")])))
    members = spark.createDataFrame([(5,), (3,), (4,)], "conv_id long")
    assert result(prefixes.prefix_nodes(turns, members)) == brute({5: [("a", "b")], 3: [], 4: []})
    assert result(prefixes.prefix_nodes(turns.limit(0), members)) == brute({5: [], 3: [], 4: []})
    assert prefixes.conversation_trie(frame(spark, []).where(F.lit(False))).count() == 0


def test_a_conversation_over_many_ranges(spark):
    rows = [(1, k, "u", f"t{k % 7}") for k in range(700)] + [(2, k, "u", f"t{k % 7}") for k in range(300)]
    got = result(prefixes.conversation_trie(frame(spark, rows)))
    assert len(got) == 701 and max(x[1] for x in got) == 700
    assert {x[3] for x in got if x[1] <= 300} == {2} and {x[3] for x in got if x[1] > 300} == {1}
    root = next(x for x in got if x[1] == 0)
    assert root[5] == 1 and root[6] == 300 * 2
