"""The registered queries next to their SQL, and brute force or held-out accuracy where SQL can't express one."""

import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from check_queries import TABLES, compare
from strataloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def frame(df):
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, data, sql, name):
    rel = sql.execute(ORACLES[name])
    want = pd.DataFrame(rel.fetchall(), columns=[d[0] for d in rel.description])
    assert compare(frame(QUERIES[name](spark, data)).astype(object), want.astype(object)) == "ok"


def test_packing_round_trip(spark, data, sql):
    got = frame(QUERIES["op4_best_two_fit"](spark, data))
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in sql.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        want |= {(i, p, a, len(ids[a:a + 4096]), zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes()))
                 for p, a in enumerate(range(0, len(ids), 4096))}
    assert {tuple(r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)} == want
    for _, x in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert (x.offset.to_numpy() == np.cumsum(x.length.to_numpy()) - x.length.to_numpy()).all() and x.length.sum() <= 4096
    assert got.sequence_id.nunique() <= 1.02 * np.ceil(got.length.sum() / 4096)


def test_mixture_meets_its_targets(spark, data, sql):
    got = frame(QUERIES["op8_mixture"](spark, data))
    docs = sql.execute("SELECT doc_id, source, text FROM documents").df()
    all_rows = got.merge(docs, on="doc_id")
    assert (all_rows["size"] == all_rows.text.map(lambda t: len(re.findall("[^\x20\x09-\x0d]+", t)))).all()
    assert (got.taken <= 3 * got["size"]).all()
    sizes = all_rows.groupby("source")["size"].sum().sort_index()
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sizes.index)}
    capped = {}
    while True:
        free = [s for s in sizes.index if s not in capped]
        rest, all_weights = sizes.sum() - sum(capped.values()), sum(weight[s] for s in free)
        target = {s: rest * weight[s] / all_weights for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            break
        capped |= {s: 3 * sizes[s] for s in over}
    target |= capped
    for source, rows in all_rows.groupby("source"):
        assert rows.target.iloc[0] == pytest.approx(target[source], rel=1e-9)
        assert abs(rows.taken.sum() - target[source]) <= 64 + 0.01 * target[source]
    again = frame(QUERIES["op8_mixture"](spark, data))
    assert got.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_quality_on_held_out_rows(spark, sql):
    folder = "/root/testdata/sf0.01"
    got = frame(QUERIES["op7_quality_classifier"](spark, folder))
    labels = duckdb.connect().execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").df()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95


def test_personal_data_equals_plain_rules(spark, data, sql):
    got = frame(QUERIES["op9_personal_data"](spark, data)).set_index("doc_id")
    import hashlib

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15))
    for i, text in sql.execute("SELECT doc_id, text FROM documents").fetchall():
        spans = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, rule, fits) in enumerate(rules)
                 for m in re.finditer(rule, text or "") if fits(m.group())]
        want = ",".join(x for _, _, x in sorted(spans))
        assert got.base_sha256[i] == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(got.spans[i].split(","))
        assert ("token = \"" in (text or "")) == ("secret" in got.spans[i])


def test_pipeline_stages(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, data))
        counts.append(docs.count())
        assert name == "packing" or docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
