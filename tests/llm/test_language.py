"""The field's probabilities against sums over all label sequences, held-out accuracy, switches and defined results."""

import itertools
import zlib

import numpy as np
import pytest

from strataloom.llm import language
from strataloom.llm.queries import QUERIES


def brute(potentials, transfer):
    n, k = potentials.shape
    found = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        p = transfer[:, labels[0]].sum() / k
        for t, x in enumerate(labels):
            p *= potentials[t, x] * (transfer[labels[t - 1], x] if t else 1)
        for t, x in enumerate(labels):
            found[t, x] += p
    return found / found.sum(axis=1, keepdims=True)


def test_marginals_equal_sums_over_all_labels(monkeypatch):
    rng = np.random.default_rng(4)
    transfer = rng.random((3, 3)) + 0.05
    lengths = np.array([7, 1, 5, 6, 2, 4])
    potentials = rng.random((lengths.sum(), 3)) ** 4 + 1e-6
    want = np.concatenate([brute(x, transfer) for x in np.split(potentials, np.cumsum(lengths)[:-1])])
    for segment in (1, 2, 3, 64):
        monkeypatch.setattr(language, "CHAIN", segment)
        assert np.allclose(language.marginals(potentials.T, lengths, transfer).T, want, rtol=1e-9)


def test_long_chains_do_not_vanish():
    rng = np.random.default_rng(5)
    potentials = np.exp(rng.uniform(-60, 0, (2, 5000)))
    transfer = np.array([[1.0, 1e-9], [1e-9, 1.0]])
    one = language.marginals(potentials, np.array([5000]), transfer)
    assert np.isfinite(one).all() and np.allclose(one.sum(axis=0), 1)
    # A chain beside others has the same probabilities as alone.
    both = language.marginals(np.concatenate([potentials, potentials[:, :70]], axis=1), np.array([5000, 70]), transfer)
    assert np.allclose(one, both[:, :5000])


def test_words_and_names():
    text = "Hello, été!x Ünï9a b"
    raw = text.encode().translate(language._BYTES)
    data = np.frombuffer(raw, np.uint8)
    starts, ends = language._words(data, np.array([0, 3, len(data)]))
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == ["hel", "lo", "été", "x", "Ünï", "a", "b"]
    # Words that a polynomial modulo 2**64 can't tell apart.
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    pair = (word[:1024] + " " + word[1024:]).encode()
    two = language._names(np.frombuffer(pair, np.uint8), np.array([0, 1025]), np.array([1024, 2049]))
    assert two[0] != two[1]


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(1)
    syllables = {"xx": ["ka", "ki", "ko"], "yy": ["shé", "thé", "mné"], "zz": ["ru", "lu", "vu"]}
    rows = [(name, ["".join(rng.choice(own, rng.integers(1, 5))) for _ in range(40)])
            for name, own in syllables.items() for _ in range(60)]
    return language.fit_field(rows)


def test_switches_inside_a_text(spark, field):
    text = "kakiko koka kiki kaka " * 30 + "shéthé mné shémné " * 40 + "12, 77 " + "ruvu lulu " * 50
    docs = spark.createDataFrame([(1, text, "und"), (2, "ruvu 1 2 3 kako", "x")], "doc_id long, text string, lang_pred string")
    got = {r["doc_id"]: r for r in language.identify(docs, field, runs=True).collect()}
    assert [(r["first"], r["n_words"], r["lang"]) for r in got[1]["runs"]] == [(0, 120, "xx"), (120, 120, "yy"), (240, 100, "zz")]
    assert got[1]["lang_pred"] in ("xx", "yy") and got[1]["score"] == pytest.approx(120 / 340, abs=0.01)
    assert np.exp(field.transitions.diagonal()).min() > np.exp(field.transitions).mean()


def test_defined_results(spark, field):
    long = "kaki koko " * 60_000
    rows = [(1, None), (2, ""), (3, "12 34 ... \n"), (4, "– … €"), (5, "kaki"), (5, "kaki"), (None, "shéthé"), (6, long), (7, "語"), (8, "qqq")]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, runs string").repartition(2)
    found = language.identify(docs, field)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in found.collect()), key=str)
    by_id = {i: (p, s) for i, p, s in got}
    assert len(got) == len(rows) and all(by_id[i] == ("und", 0.0) for i in (1, 2, 3, 4))
    assert by_id[5][0] == by_id[6][0] == "xx" and by_id[None][0] == "yy" and by_id[6][1] > 0.99
    assert by_id[7][0] in field.languages and by_id[8][0] in field.languages
    assert language.identify(docs.limit(0), field).count() == 0
    none = docs.select("doc_id", "text").selectExpr("*", "cast(null as string) lang")
    nothing = language.learn_languages(none)
    assert nothing.languages == []
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs, nothing, runs=True).collect()} == {("und", 0.0)}
    assert language.identify(docs, language.fit_field([("xx", ["kaki"])])).where("lang_pred = 'xx'").count() == 6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op13_language"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert (both.held_out == both.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = both[both.held_out & both.lang.notna()]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.98 and got.score.between(0, 1).all()
