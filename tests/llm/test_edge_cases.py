"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strataloom.llm import chat, embeddings, minhash, mixing, packing, pii, quality, repeats, rules

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, taken long, words string, "
          "score double, node long, digest string, base string, kept string, length long, key string")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "one two three four five six seven eight nine ten\nsecond line of the first text"),
    (2, "one two three four five six seven eight nine ten\nsecond line of the first text"),
    (2, "one two three four five six seven eight nine ten\nsecond line of the first text"),
    (3, None), (4, ""), (5, " \n\t \x0b"), (6, "word"), (7, LONG), (8, LONG + " more"), (None, "no id here"), (None, None),
    (9, "mail me at a.b@c.org or +1 (212) 555-0199 from 10.0.0.1, token = \"0123456789abcdef0123456789abcdef\""),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 3 else "en", "ab"[i % 2] if i else None, None, 7, 7, "w", 0.5, i, "d", "b", "k", 1, "x")
            for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r.asDict())
    return out


def test_rules(docs, none):
    got = by_id(rules.apply_rules(docs))
    assert sum(map(len, got.values())) == len(ROWS) and rules.apply_rules(none).count() == 0
    assert got[3][0]["n_words"] == got[4][0]["n_words"] == got[5][0]["n_words"] == 0 and got[5][0]["base_failed"]
    assert got[7][0]["n_words"] == 60_000 and got[2][0] == got[2][1]


def test_personal_data(docs, none):
    got = by_id(pii.find_personal_data(docs).withColumn("all", pii.span_list(F.concat("base", "added"))))
    assert pii.find_personal_data(none).count() == 0 and sum(map(len, got.values())) == len(ROWS)
    assert got[3][0]["all"] == got[4][0]["all"] == got[None][0]["all"] == ""
    assert got[9][0]["all"].startswith("email:11:20,phone:24:41,ip:47:55,secret:66:98")


def test_packing(docs, none):
    got = by_id(packing.pack(docs, WORD))
    assert packing.pack(none, WORD).count() == 0
    assert [x["length"] for x in got[3] + got[4] + got[5]] == [1, 1, 1] and len(got[2]) == 2
    pieces = sorted(got[7], key=lambda x: x["piece"])
    assert [x["length"] for x in pieces[:-1]] == [4096] * (len(pieces) - 1) and pieces[1]["start"] == 4096
    seen = sorted((x["sequence_id"], x["offset"], x["length"]) for rows in got.values() for x in rows)
    end = {}
    for s, at, n in seen:
        assert at == end.get(s, 0) and at + n <= 4096 and n > 0
        end[s] = at + n


def test_mixing(spark, docs, none):
    got = by_id(mixing.mixture(docs, block_words=4))
    assert mixing.mixture(none).count() == 0 and mixing.mix(none).count() == 0
    assert sum(map(len, got.values())) == len(ROWS)
    assert all(x["taken"] <= 3 * x["size"] for rows in got.values() for x in rows) and got[3][0]["taken"] == 0
    mixed = mixing.mix(docs, block_words=4)
    assert mixed.columns == docs.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    # The repeated rows of id 2 count as one text in the output rows and take their words apart.
    assert abs(words - sum(x["taken"] for rows in got.values() for x in rows)) <= 40


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 7, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        model = quality.fit_quality(docs, table)
        got = quality.with_score(docs, model, name="quality_score").collect()
        assert len(got) == len(ROWS) and all(0 <= r["quality_score"] <= 1 for r in got)
    assert quality.with_score(none, model, name="s").count() == 0 and quality.fit_quality(none, labels).rules == ()


def test_near_documents(docs, none):
    got = by_id(minhash.near_documents(docs))
    assert minhash.near_documents(none).count() == 0 and sum(map(len, got.values())) == len(ROWS)
    assert {i: got[i][0]["component_id"] for i in range(1, 9)} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7}
    assert [r["component_id"] for r in got[None]] == [None, None] and all(r["kept"] for r in got[None])
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3


def test_repeated_strings(docs, none):
    got = by_id(repeats.without_repeats(docs, keep_text=True))
    assert repeats.without_repeats(none).count() == 0 and sum(map(len, got.values())) == len(ROWS)
    assert [r["n_removed"] for r in got[2]] == [len(ROWS[0][1])] * 2 and got[1][0]["n_removed"] == 0
    # The words of the long text come again, so the blank after its last word does, too.
    assert got[8][0]["n_removed"] == len(LONG) + 1 and got[8][0]["kept"] == b"more" and got[8][0]["n_spans"] == 1
    assert got[3][0]["kept_sha256"] == hashlib.sha256(b"").hexdigest()


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]),
            (7, [nan, 1.0, 0.0]), (8, [inf, 1.0, 0.0]), (9, [1.0, None, 0.0]), (10, [1.0, 0.0]), (11, [1e-200, 0.0, 0.0]),
            (None, [1.0, 0.0, 0.0]), (12, [0.0, 1.0, 0.0]), (13, [0.91, 0.4, 0.0])]
    df = spark.createDataFrame([(i, v, 3, "x", 5) for i, v in rows], "vec_id long, embedding array<double>, label int, vec string, cls long")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_vectors(df).collect()}
    assert len(got) == len(rows)
    assert got[1] == (4, 1, True) and got[2] == got[3] == got[11] == (4, 1, False) and got[13] == (4, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 12)) and got[None] == (0, None, True)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 1, "assistant", "b <|im_end|> c"), (1, 0, "user", "</s>[INST] \\ <\\|im_end|>"), (2, None, None, None),
            (2, 0, "assistant", ""), (None, 0, "assistant", "x"), (3, 0, "user", "same"), (3, 0, "user", "same"),
            (4, 0, "assistant", "é😀 " * 30_000)]
    df = spark.createDataFrame([(*r, 7, "i") for r in rows], "conv_id long, turn long, role string, text string, position int, ids string")
    made = chat.format_conversations(df, BYTE)
    got = {r["conv_id"]: r for r in chat.read_back(made, BYTE).collect()}

    def digest(*turns):
        return hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()

    assert got[1]["turns_sha256"] == digest(("user", rows[1][3]), ("assistant", rows[0][3]))
    assert got[1]["loss_sha256"] == hashlib.sha256(rows[0][3].encode()).hexdigest() and got[1]["loss_chars"] == len(rows[0][3])
    assert got[2]["turns_sha256"] == digest(("", ""), ("assistant", "")) and got[2]["n_turns"] == 2
    assert got[3]["n_turns"] == 2 and got[None]["loss_chars"] == 1 and got[4]["loss_chars"] == 90_000
    places = sorted((r["position"], len(r["ids"])) for r in made.where("conv_id = 1").collect())
    assert places[0][0] == 0 and places[1][0] == places[0][1]
    assert chat.read_back(chat.format_conversations(df.limit(0), BYTE), BYTE).count() == 0


@pytest.mark.parametrize("text", ["<|im_end|>", "<\\|im_end|>", "<\\\\</s>", "<<SYS>> <</SYS>>", "[INST][/INST]", "<<|im_sep|>", "\\", "<s", ""])
def test_escapes_are_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)


def test_packing_with_a_vocabulary_whose_words_cannot_be_encoded_apart(spark):
    from tokenizers import Tokenizer

    with open(BYTE, encoding="utf-8") as f:
        content = f.read()
    assert not packing.words_stand_alone(content)
    with pytest.raises(ValueError):
        packing.WordIds(content)
    r = random.Random(2)
    texts = ["".join(r.choice("aB é.,\n\t'1中") for _ in range(r.randint(0, 60))) for _ in range(300)]
    plain = Tokenizer.from_file(BYTE)
    rows = list(enumerate(texts))
    for path, encoder in ((BYTE, plain), (WORD, Tokenizer.from_file(WORD))):
        got = packing.tokenized_pieces(spark.createDataFrame(rows, "doc_id long, text string"), path)
        found = {x["doc_id"]: list(x["ids"]) for x in got.collect()}
        assert found == {i: encoder.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}


def test_mix_keeps_columns_named_like_helpers_and_takes_runs_of_words(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(r.randint(0, 40))), "abc"[i % 3], i + 5, "x", 7) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __row long, __ranges string, size long")
    got = mixing.mix(df, block_words=4)
    assert got.columns == df.columns
    taken = {x["doc_id"]: x["taken"] for x in mixing.mixture(df, block_words=4).collect()}
    words = dict.fromkeys(taken, 0)
    for x in got.collect():
        assert (x["__row"], x["__ranges"], x["size"]) == (x["doc_id"] + 5, "x", 7)
        numbers = [int(w.split("x")[1]) for w in x["text"].split()]
        assert numbers == sorted(set(numbers))
        words[x["doc_id"]] += len(numbers)
    assert words == taken


def test_repeats_are_worked_on_in_small_pieces():
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from strataloom.llm import repeats

    frame = pd.DataFrame({"doc": range(4_500)})
    for batch in (frame, pa.RecordBatch.from_pandas(frame)):
        assert [len(x) for x in repeats._pieces(iter([batch]))] == [2_000, 2_000, 500]
    order, same = repeats.equal_strings(np.zeros(10, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), repeats.Prefixes())
    assert not len(order) and not len(same)


def test_a_worker_builds_its_encoder_once(spark, tmp_path):
    import public_tokenizers

    marks = tmp_path / "made"
    marks.mkdir()

    class Counted(packing.WordIds):
        def __init__(self, content):
            super().__init__(content)
            open(f"{marks}/{id(self)}-{time.time_ns()}", "w").close()

    import time
    was, packing.WordIds = packing.WordIds, Counted
    try:
        docs = spark.createDataFrame([(i, f"Some words, {i} of them") for i in range(40)], "doc_id long, text string").repartition(40)
        rows = packing.tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False).collect()
    finally:
        packing.WordIds = was
    assert len(rows) == 40 and 1 <= len(list(marks.iterdir())) <= 8  # workers, not tasks
