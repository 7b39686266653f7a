"""The pipeline against plain Python over the same rows, stage by stage."""

from __future__ import annotations

import re
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F
from small_corpus import frame, texts
from test_dedup import lower, plain_fingerprint, roots
from test_scans import secret_spans

import __spark_entry__ as contract
from tablesync.llm import quality_knn
from tablesync.llm.common import documents, labels
from tablesync.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def masked(text: str) -> str:
    out, at = [], 0
    for span in filter(None, secret_spans(text).split(",")):
        kind, start, end = span.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join([*out, text[at:]])


def test_run_equals_plain_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_knn", "exact_dedup", "simhash", "secret_scan", "packing"]
    score = quality_knn.score_column(quality_knn.fit(documents(spark, SF), labels(spark, SF)), F.col("text"))
    scored = documents(spark, SF).select("doc_id", "text", score.alias("score")).collect()
    kept = {r.doc_id: r.text for r in scored if r.score >= quality_knn.ACCEPTED}
    last = {}
    for i, text in kept.items():
        last[lower(text)] = max(i, last.get(lower(text), i))
    kept = {i: t for i, t in kept.items() if last[lower(t)] == i}
    ids = sorted(kept)
    prints = [plain_fingerprint(kept[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    kept = {ids[root]: kept[ids[root]] for root in roots(len(ids), links)}
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: whole.encode(masked(t), add_special_tokens=False).ids + [0] for i, t in kept.items()}
    got = {}
    for row in corpus_pipeline.run(spark, SF).collect():
        got.setdefault(row.doc_id, []).append((row.start, np.frombuffer(row.ids, "<u2").tolist()))
    assert {i: sum((ids for _, ids in sorted(parts)), []) for i, parts in got.items()} == want


def test_stages_keep_the_columns(spark):
    docs = documents(spark, SF).limit(60).withColumn("node", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_on_odd_input(spark):
    docs = frame(spark, texts() + [texts()[6]] * 3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(range(docs.count()))


def test_registered(spark):
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert contract.queries().keys() >= {*QUERIES, "pipeline"} and ORACLES.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    db = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    answer = db.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    rows = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(answer.fetchall())
