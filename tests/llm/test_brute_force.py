"""Operators on small hostile inputs against brute force, with small batches and blocks."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from strataloom.llm import embeddings, graph, minhash, mixing, packing, pii, repeats


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components_of_chains_stars_and_pairs(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 299), (299, 301), (7, 7)]
    r.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x["node"]: x["component"] for x in graph.components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}, 299: 299, 300: 299, 301: 299}
    assert graph.components(df.limit(0)).count() == 0


def brute_repeats(rows, length=50):
    seen = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for k in range(len(raw) - length + 1):
                s = raw[k:k + length]
                seen[s] = min(seen.get(s, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        if i is not None:
            for k in range(len(raw) - length + 1):
                if seen[raw[k:k + length]] < i:
                    gone[k:k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowded", [1000, 2])
def test_repeated_strings(spark, small_batches, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "PART_SEGMENTS", crowded)
    monkeypatch.setattr(repeats, "SORTED_TOGETHER", 60)
    r = random.Random(5)
    passages = ["".join(r.choice("abcdé ") for _ in range(n)) for n in (49, 50, 51, 60, 90, 140, 300)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages)[r.randint(0, 5):] if r.random() < 0.6 else "".join(r.choice("ab ") for _ in range(r.randint(0, 60)))
                 for _ in range(r.randint(0, 5))]
        rows.append((r.randint(0, 45), "".join(parts)))
    rows += [(None, passages[4] * 2), (50, "a" * 400), (51, "a" * 49), (52, "a" * 120), (53, None), (54, "ab" * 300), (55, "ba" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(x) for x in repeats.without_repeats(df).collect()), key=str) == brute_repeats(rows)


def test_suffix_order_sorts_by_group_and_bytes():
    r = random.Random(2)
    data = np.array([r.randint(97, 98) for _ in range(3000)], np.uint8)
    starts = np.array(r.sample(range(2900), 800))
    group = np.array([r.randint(0, 3) for _ in starts])
    order, same = repeats.equal_strings(data, starts, group, repeats.Prefixes())
    keys = [(int(group[k]), data[starts[k]:starts[k] + 50].tobytes()) for k in order]
    assert keys == sorted(keys) and same.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:])]


def brute_near(rows, part=85, whole=100):
    sets = []
    for i, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = {i: i for i, _ in rows if i is not None}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                if whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b]):
                    x, y = root(rows[a][0]), root(rows[b][0])
                    group[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for (i, _), s in zip(rows, sets)), key=str)


def test_near_documents_of_edited_families(spark, small_batches, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "LARGE", 3)
    r = random.Random(8)
    rows = []
    for f in range(4):
        base = [f"w{f}x{r.randint(0, 400)}" for _ in range(120)]
        for _ in range(25):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4, 6])):
                text[r.randrange(len(text))] = f"e{r.randint(0, 9999)}"
            rows.append((len(rows), " ".join(text)))
    shared = " ".join(f"hot{k}" for k in range(40))
    rows += [(len(rows) + k, shared + " " + " ".join(f"o{k}y{j}" for j in range(r.randint(1, 30)))) for k in range(30)]
    rows += [(3, rows[40][1]), (None, rows[0][1]), (500, "three words only"), (501, "Three Words  only"), (502, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(x["doc_id"], x["n_shingles"], x["component_id"]) for x in minhash.near_documents(df).collect()]
    assert sorted(got, key=str) == brute_near(rows)


def test_near_vectors_of_families(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "VECTORS_PER_CELL", 20)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    for f in range(3):
        x[f * 40:f * 40 + 40] = x[f * 40] + rng.normal(size=(40, 16)) * rng.choice([0.05, 0.2, 0.35], size=(40, 1))
    x[250:260] = x[240]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    want = close.sum(1)
    found = np.array([got[i][0] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert [got[i][1] for i in range(240, 260)] == [240] + list(range(241, 250)) + [240] * 10


def low_rank(rng, n):
    """Half of the vectors are planted at cosine 0.91 from the others, inside 8 of 64 dimensions."""
    z = rng.normal(size=(n // 2, 8))
    z /= np.linalg.norm(z, axis=1)[:, None]
    t = rng.normal(size=z.shape)
    t -= (t * z).sum(1)[:, None] * z
    t /= np.linalg.norm(t, axis=1)[:, None]
    return np.concatenate([z, 0.91 * z + np.sqrt(1 - 0.91 ** 2) * t]) @ np.linalg.qr(rng.normal(size=(64, 8)))[0].T


def clustered(rng, n):
    """300 clusters with spectrum 1/i."""
    s = 1 / np.arange(1, 65)
    return (rng.normal(size=(300, 64)) * s)[rng.integers(0, 300, n)] + rng.normal(size=(n, 64)) * s * 0.3


@pytest.mark.parametrize("made", [low_rank, clustered])
def test_near_vectors_of_low_dimension(spark, monkeypatch, made):
    monkeypatch.setattr(embeddings, "VECTORS_PER_CELL", 16)
    x = made(np.random.default_rng(1), 6000)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = (u @ u.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(df).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.985 * want.sum()


def test_one_large_group_does_not_set_the_level():
    probe = np.array([0, 1, 2, 3])
    level, links = np.array([0.0, 0.1, 0.2, 0.3]), np.array([10**6, 1, 1, 1])
    assert embeddings.level_for(probe, level, links, 0.99) == 0.3


def test_permutations_are_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 64, 1000):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("s")).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_mix_treats_repeated_rows_on_their_own(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30 + i % 7)), "web", f"l{i}", "x") for i in range(40)]
    rows += [(7, rows[7][1], "web", f"copy{k}", "y") for k in range(20)]
    rows += [(i, f"a{i} b c", "books", "en", "z") for i in range(50, 250)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, extra string").repartition(3)
    got = mixing.mix(df, block_words=4).collect()
    taken = {}
    for r in mixing.mixture(df, block_words=4).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    words, passes = {}, {}
    for r in got:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        passes[r["doc_id"], r["lang"]] = passes.get((r["doc_id"], r["lang"]), 0) + 1
    assert words == {i: n for i, n in taken.items() if n}
    assert max(passes.values()) <= mixing.MOST_PASSES
    assert {lang for i, lang in passes if i == 7} > {"copy0", "copy1", "copy2"}


def test_pipeline_rows_make_up_sequences(spark):
    import zlib

    import corpus_pipeline

    rows = [(1, "one two three"), (1, "three two one"), (1, "one two three"), (2, "w " * 9000), (3, "a b"), (None, "c")]
    got = corpus_pipeline.packing(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    made = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        sequence = made.setdefault(r["sequence_id"], [])
        assert len(sequence) == r["offset"]
        sequence += r["ids"]
    assert max(map(len, made.values())) <= 4096
    assert sum(r["doc_id"] == 1 for r in got) == 3 and len({tuple(r["ids"]) for r in got if r["doc_id"] == 1}) == 2


def test_patterns_use_every_piece_once():
    r = random.Random(3)
    counts = {}
    for _ in range(4000):
        k = min(4096, int(r.expovariate(1 / 700)) + 1)
        counts[k] = counts.get(k, 0) + 1
    patterns = packing.sequence_patterns(counts)
    used = {}
    for lengths, times in patterns:
        assert sum(lengths) <= 4096
        for k in lengths:
            used[k] = used.get(k, 0) + times
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    assert sum(times for _, times in patterns) <= -(-total // 4096) + 1
    assert packing.sequence_patterns({}) == []


def test_two_smaller_pieces_take_the_place_of_one():
    # Greedy takes 60 and 30 and leaves 10 of 100; 25 and 15 fill the place of 30 without a gap.
    assert packing.sequence_patterns({60: 1, 30: 1, 25: 1, 15: 1}, 100)[0] == ([60, 25, 15], 1)


def test_candidates_are_dropped_only_for_base_spans_that_overlap_them():
    r = random.Random(6)
    parts = ["ssn=", "123-45-6789", "/", "joe@x.com", " ", "10.0.0.1", "+", "4111111111111111", "abcdef0123456789ABCDEF", "555-1234", "_"]
    texts = ["ssn=123-45-6789/joe@x.com"] + ["".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(2000)]
    for text in texts:
        taken = pii.base_spans(text)
        want = [c[:3] for c in pii.candidate_spans(text, [])]
        want = [(k, s, e) for k, s, e in want if not any(a < e and s < b for _, a, b in taken)]
        assert [c[:3] for c in pii.candidate_spans(text, taken)] == want
    found = pii.candidate_spans(texts[0], [("email", 16, 25)])
    assert ("social", 4, 15) in [c[:3] for c in found]


def test_words_that_collide_under_polynomial_hashes_do_not_link(spark):
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, two), (3, one.upper()), (4, f"{one} {two}"), (5, f"{two} {one}")]
    found = minhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_units_of_words_give_the_ids_of_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    r = random.Random(8)
    signs = "abcdeSTRZ019'.,!-_  \n\t\x0b\x1c\x85\xa0éÉßİΣσẞ²Ⅷ—\u0301\u200d中文가각\u1100\u1161ªʰ😀٣"
    plain = "abcdestrvmlST'' .,5 \n"
    texts = ["".join(r.choice(r.choice([signs, plain])) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(r.choice(plain) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["don't 'STREET we'll I'd y'all 'T 'lled", "a" * 5000, "a1" * 3000, "'" * 2000 + "s", "", " \n "]
    assert list(packing.WordIds(vocabulary).of(texts)) == list(packing.TextIds(vocabulary).of(texts))
