"""The pipeline against a plain Python version of its first four stages, and its packing against their result."""

import os
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from corpusloom.llm import quality_rules, toxicity

DATA = "/root/testdata/sf0.001"


def verdict(t):
    words = re.findall(r"[^\t\n\x0b\f\r ]+", t)
    solid = len(re.sub(r"[\t\n\x0b\f\r ]", "", t))
    lines = [x for x in t.split("\n") if re.search("[^\t\r ]", x)]
    stop = set(quality_rules.STOP_WORDS.split())
    ratio = lambda a, b: round(a / b, 6) if b else 0.0
    m = {
        "n_words": len(words),
        "mean_word_length": ratio(solid, len(words)),
        "symbol_ratio": ratio(sum(c in quality_rules.SYMBOLS for c in t), len(t)),
        "shout_ratio": ratio(t.count("!!"), len(words)),
        "capital_ratio": ratio(sum(c.isupper() for c in t), solid),
        "stop_word_ratio": ratio(sum(w in stop for w in re.split(r"[\W\d_]+", t.lower())), len(words)),
        "bullet_line_ratio": ratio(sum(bool(re.match("[\t\r ]*[-*•]", x)) for x in lines), len(lines)),
        "ellipsis_line_ratio": ratio(sum(x.endswith(("...", "…")) for x in lines), len(lines)),
        "duplicate_line_ratio": ratio(len(lines) - len(set(lines)), len(lines)),
    }
    for name, metric, how, limit, least in quality_rules.RULES:
        if limit is not None and (m[metric] < limit if how == "<" else m[metric] > limit) and m["n_words"] >= least:
            return name
    return None


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    flags = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {i: t for i, t in docs.items() if verdict(t) is None}
    model = toxicity.fit([(i, t, flags[i]) for i, t in kept.items() if i in flags])
    if model:
        score = model.scorer()
        kept = {i: t for i, t in kept.items() if not score(t)[2]}
    first = {}
    for i in sorted(kept):
        first.setdefault(kept[i], i)
    kept = {i: t for t, i in first.items()}
    sets = {}
    for i, t in kept.items():
        w = t.lower().split()
        k = min(5, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]) and find(a) != find(b):
                a_, b_ = sorted((find(a), find(b)))
                parent[b_] = a_
    kept = {i: t for i, t in kept.items() if find(i) == i}
    got = defaultdict(int)
    bins = defaultdict(int)
    for r in corpus_pipeline.run(spark, DATA).collect():
        got[r.doc_id] += r.n_tokens
        bins[r.bin_id] += r.n_tokens
    assert dict(got) == {i: len(t.split()) for i, t in kept.items()}
    assert max(bins.values()) <= 2048 and sorted(bins) == list(range(len(bins)))


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame([(1, "The cat is on the mat and it is fine.", "x"), (1, "The cat is on the mat and it is fine.", "x"), (None, None, None)], "doc_id bigint, text string, _gone string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if os.path.isdir(DATA):
            docs = stage(spark, docs, DATA)
            assert docs.columns == ["doc_id", "text", "_gone"], name
    assert [r.doc_id for r in docs.collect()] == [1]
