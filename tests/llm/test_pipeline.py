import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ebbtide.llm import queries
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


def bare(text):
    return "".join(c for c in text or "" if c not in SPACE)


def step(spark, tmp_path, name, docs):
    """A stage's result, written and read again as the runner does."""
    path = str(tmp_path / name.replace(" ", "-"))
    dict(corpus_pipeline.STAGES)[name](spark, docs, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in queries.op4_toxicity(spark, SF).collect() if r.predicted}

    first = step(spark, tmp_path, "toxicity", docs)
    assert first.columns == docs.columns
    left = {r.doc_id: r.text for r in first.collect()}
    assert left == {k: t for k, t in texts.items() if k not in toxic}

    second = step(spark, tmp_path, "exact dedup", first)
    assert sorted(second.columns) == sorted(docs.columns)
    groups = defaultdict(list)
    for k, t in left.items():
        groups[bare(t)].append((-len(t), k))
    left = {min(g)[1]: left[min(g)[1]] for g in groups.values()}
    assert {r.doc_id: r.text for r in second.collect()} == left

    third = step(spark, tmp_path, "near dedup", second)
    assert sorted(third.columns) == sorted(docs.columns)
    prints = [(k, plain_fingerprint(t)) for k, t in left.items()]
    components = plain_components(prints)
    left = {k: left[k] for k, f in prints if components[f] == k}
    assert {r.doc_id: r.text for r in third.collect()} == left

    fourth = step(spark, tmp_path, "source mix", third)
    assert sorted(fourth.columns) == sorted(docs.columns)
    copies = Counter(r.doc_id for r in fourth.collect())
    assert set(copies) <= set(left) and max(copies.values()) <= 3
    assert all(r.text == left[r.doc_id] for r in fourth.collect())
    words = {k: len(t.split()) for k, t in left.items()}
    assert abs(sum(words[k] * n for k, n in copies.items()) - sum(words.values())) < 0.2 * sum(words.values())

    last = step(spark, tmp_path, "encoding", fourth)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_FILE))
    rows = last.collect()
    assert Counter(r.doc_id for r in rows) == copies
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(left[r.doc_id], add_special_tokens=False).ids
        assert r.round_trip and r.n_tokens == len(r.ids) // 4


def test_run_gives_the_same_rows(spark):
    first = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())
    assert first and first == sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())


def test_awkward_rows(spark, docs, awkward):
    """Nulls everywhere, repeated rows and clashing extra columns pass through all stages."""
    rows = awkward + [(100 + i, "".join(random.Random(i).choice("abc d\n") for _ in range(400))) for i in range(30)]
    frame = docs(rows).selectExpr(
        "doc_id", "text", "CAST(NULL AS string) AS lang", "if(doc_id % 2 = 0, 's', NULL) AS source", "1L AS n_chars", "2 AS fp", "3 AS row", "4 AS toxic_score", "5 AS __group", "6 AS copies"
    )
    sf_dir, now = SF, frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert sorted(now.columns) == sorted(frame.columns), name
    assert now.filter("fp <> 2 OR row <> 3 OR toxic_score <> 4 OR copies <> 6").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).filter("NOT round_trip").count() == 0


def test_empty_table(spark, docs):
    empty = docs([]).selectExpr("doc_id", "text", "'' AS lang", "'' AS source", "0L AS n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
