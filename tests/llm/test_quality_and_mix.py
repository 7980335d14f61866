import re
from collections import Counter, defaultdict

import pytest

from ebbtide.llm import decision_list, mixing, queries
from ebbtide.llm.common import Scratch

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def base(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_of_awkward_texts(docs, awkward):
    rows = awkward + [(20, "a b c a b c a b c"), (21, "a a a a"), (22, "x y\nx y\n \n\nx y \n z"), (23, "# * $ %% && || <>" * 30), (24, "a b\x0bc\x1ca b\u0085c a b c")]
    got = sorted(((repr(r.doc_id), base(r)) for r in decision_list.statistics(docs(rows)).collect()))
    assert got == sorted((repr(k), plain_base(t)) for k, t in rows)
    assert decision_list.statistics(docs([])).count() == 0


def test_learned_rules_reject_bad_rows(spark, docs):
    """A planted conjunction is found, prose is kept, and the list is a plain Spark condition."""
    prose = " ".join(f"w{i % 37}x{i}" for i in range(120))
    rows = [(i, prose + f" {i}") for i in range(150)] + [(1000 + i, " ".join(f"q{i}{j}***" for j in range(90))) for i in range(150)]
    marks = spark.createDataFrame([(k, int(k < 1000)) for k, _ in rows] + [(None, 0), (5000, 0), (3, None)], "doc_id long, quality int")
    found = decision_list.quality(docs([*rows, (None, None), (7000, prose)]), marks)
    assert all(r.kept == (r.doc_id is not None and (r.doc_id < 1000 or r.doc_id == 7000)) for r in found.collect())


def test_without_labels_only_the_base_decides(spark, docs):
    prose = " ".join(f"w{i}" for i in range(120))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in decision_list.quality(docs([(1, prose), (2, "short")]), none).collect()} == {1: True, 2: False}


def test_sequential_covering_stops_at_noise(spark):
    """Labels that no statistic explains give no rule."""
    rows = [(bool((i * 7919) % 5 == 0), i % 3, *[float((i * p) % 101) for p in (3, 5, 7, 11, 13, 17, 19, 23)]) for i in range(900)]
    schema = "bad boolean, part int, " + ", ".join(f"{s} double" for s in decision_list.STATISTICS)
    assert decision_list.learn(spark.createDataFrame(rows, schema), Scratch(spark, "test")) == []


def test_whole_table(spark, texts):
    rows = queries.op2_quality(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert base(r) == plain_base(texts[r.doc_id]) and not (r.kept and r.base_failed)


def test_plans_have_no_python(spark):
    for query in (queries.op2_quality, queries.op6_mixing):
        assert not re.search("Python|Pandas|Arrow", query(spark, SF)._jdf.queryExecution().executedPlan().toString())


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: size} -> {source: target}, by giving the excess away until nothing is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, fixed, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_sources = [s for s in order if s not in fixed]
        share = sum(weight[s] for s in open_sources)
        for s in open_sources:
            target[s] = left * weight[s] / share
        above = [s for s in open_sources if target[s] > most * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = float(most * sizes[s])
            fixed.add(s)
            left -= target[s]


def check_mix(rows, tolerance):
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append(r)
    targets = plain_targets({s: sum(r["size"] for r in own) for s, own in sources.items()})
    for s, own in sources.items():
        total = sum(r["size"] for r in own)
        assert all(r.source_size == total and r.target == pytest.approx(targets[s]) for r in own)
        assert all(0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in own)
        if total:
            expected = targets[s] / total
            units = [r for r in own if r["size"]]
            # The pivotal method keeps the sum of copies within one of its expectation.
            assert abs(sum(r.taken // r["size"] for r in units) - expected * len(units)) < 1 + 1e-6
            largest = max(r["size"] for r in units)
            assert abs(sum(r.taken for r in own) - targets[s]) <= max(3 * largest, tolerance * targets[s])


@pytest.mark.parametrize("block", [128, 3])
def test_mix_of_uneven_sources(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = [(i, "w " * (1 + i % 17), "hot" if i % 3 else f"s{i % 7}") for i in range(700)]
    rows += [(i, "x", None) for i in range(700, 730)] + [(9, "same words", "hot")] * 400 + [(None, None, "hot"), (None, "a b", ""), (801, "", "é")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS row", "3 AS p", "4 AS target")
    first, again = (sorted(mixing.mix_documents(frame).collect(), key=repr) for _ in range(2))
    assert first == again and len(first) == len(rows)
    check_mix(first, 0.05)
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    counts = Counter((r.doc_id, r.source) for r in mixed.collect())
    want = Counter()
    for r in first:
        want[r.doc_id, r.source] += r.copies
    assert counts == +want


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_documents(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_copies_have_the_right_expectation(spark, monkeypatch):
    """Over many seeds each document of a source is taken as often as its target asks for."""
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, seeds = Counter(), 12
    for seed in range(seeds):
        monkeypatch.setattr(mixing, "SEED", seed * 1000)
        for r in mixing.mix_documents(frame).collect():
            taken[r.doc_id] += r.copies
            expected = r.target / r.source_size
            assert r.copies in (int(expected), int(expected) + 1)
    by_source = [sum(taken[i] for i in range(s, 40, 2)) / (20 * seeds) for s in (0, 1)]
    assert by_source[0] / by_source[1] == pytest.approx(2.5, rel=0.2)


def test_whole_mix(spark, texts):
    rows = queries.op6_mixing(spark, SF).collect()
    assert {r.doc_id: r["size"] for r in rows} == {k: len(WORD.findall(t)) for k, t in texts.items()}
    check_mix(rows, 0.1)
