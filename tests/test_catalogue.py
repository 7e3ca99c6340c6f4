"""Every query with SQL against DuckDB on the smallest tables, and hand-computed cases for the reference's quirks."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import dedup, filters, mixing, ordering, vocabulary
from corpusloom.plans import curation, normalizers
from corpusloom.plans.catalogue import QUERIES, SQL
from corpusloom.sources import files, shared

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    if os.path.isdir(DATA):
        for f in os.listdir(DATA):
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(df):
    def cell(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        return "None" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "f,given,wanted",
    [
        (T.md_links, "[a](b) c", "a c"),
        (T.wiki_clean, "A (, ;) B", "A  B"),
        (T.wiki_clean, "x {{t}} y\nTham khảo\nz", "x  y\n"),
        (T.paper_trim, "T\nauthors\nAbstract x\nReferences y", "T\nAbstract x\n"),
        (T.paper_trim, "T\nReferences y\nAbstract x", "T\n"),
        (T.book_unwrap, "Title\nthe cat\nsat.\nNext", "the catsat.\nNext"),
        (T.book_unwrap, "www.gutenberg.org/license. more", ""),
        (lambda c: T.normalize_text(c, True, False), "     x    ", "x"),
        (lambda c: T.normalize_text(c, True, False), "     - x", "     - x"),
        (T.normalize_text, "“a”…", '"a".'),
        (T.legal_clean, "**\\_\\_** a /.", " a "),
        (T.pii_redact, "me@x.org at 8.8.8.8 not 10.0.0.1", "email@example.com at 22.214.171.124 not 10.0.0.1"),
        (T.capitalized, "hELLO wORLD", "Hello world"),
        (T.unescape_newlines, "a\\nb", "a\nb"),
        (T.endpoint_key, "https://a.vn/index.php/j/oai", "a.vn_j"),
        (T.journal_key, "https://a.vn/index.php/j", "a.vn_j"),
        (T.journal_key, "https://a.vn/vi", "a.vn"),
        (T.file_kind, "..../Image/..", "scanned"),
        (T.md_links, None, None),
        (lambda c: T.meta_refresh(c), '<META http-equiv=refresh content="5; URL=https://a.b/c">', "https://a.b/c"),
        (lambda c: F.array_join(T.license_urls(c), " "), "'https://creativecommons.org/licenses/by/4.0/' https://creativecommons.org/x", "https://creativecommons.org/licenses/by/4.0/"),
        (lambda c: F.array_join(T.external_links(c), " "), '<a href="https://j.vn/a/issue/archive" target="_blank">', "https://j.vn/a"),
        (T.friendly_name, "owner/Family-1.7B", "Family"),
        (lambda c: T.inferred_endpoint(c, F.lit("x https://hub.vn/index.php/ab-c/y"), ".vn", "https://hub.vn/index.php/"), "https://j.vn/index", "https://hub.vn/index.php/ab-c"),
        (lambda c: T.inferred_endpoint(c, F.lit("none"), ".vn", "https://hub.vn/index.php/"), "https://j.vn/", None),
        (lambda c: T.inferred_endpoint(c, F.lit("none"), ".vn", "https://hub.vn/index.php/"), "https://j.vn/index.php/j", "https://j.vn/index.php/j/oai"),
        (T.normalize_text, "\x1b[31mred\x1b[0m\x07", "red"),
    ],
)
def test_text(spark, f, given, wanted):
    assert one(spark, given, f) == wanted


def test_book_of_many_lines(spark):
    import time

    lines = ["Title", *[f"line {i}" + "." * (i % 3 == 0) for i in range(30_000)], "Last"]
    began, got = time.time(), one(spark, "\n".join(lines), T.book_unwrap)
    assert got == "".join(x + "\n" * (x.endswith(".") or y[0].isupper()) for x, y in zip(lines[1:], lines[2:])) + "Last"
    # splitting the text again for each line took minutes
    assert time.time() - began < 20


def test_bankers_rounding(spark):
    df = spark.createDataFrame([(2.5,), (2.51,), (3.5,)], "x double")
    assert [r.x for r in df.where(F.bround("x", 0) >= 3).collect()] == [2.51, 3.5]


def test_licenses(spark):
    df = spark.createDataFrame([(["https://creativecommons.org/licenses/by-nc-nd/4.0"],), (["https://creativecommons.org/licenses/by-sa/4.0/"],), ([],)], "l array<string>")
    assert [r[0] for r in df.select(T.license_ok(F.col("l"))).collect()] == [False, True, False]


def test_flagged_words(spark):
    docs = spark.createDataFrame([(1, "bad bad ok"), (2, "this is very bad stuff"), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_flagged, r.ratio, r.keep) for r in filters.flagged_words(docs, {"bad": 3, "very bad": 5}, keep_fraction=0).collect()}
    assert got == {1: (1, 0.0, True), 2: (1, 0.2, False), 3: (0, 0.0, True)}


def test_whitelist(spark):
    df = spark.createDataFrame([("https://a.example.com/x", True), (None, True), ("https://b.org", True), ("https://b.org", False)], "url string, bad boolean")
    assert [r[0] for r in df.select(filters.with_whitelist(F.col("bad"), F.col("url"), ("example.com",))).collect()] == [True, True, False, True]
    with pytest.raises(Exception, match="no url"):
        df.select(filters.with_whitelist(F.col("bad"), F.col("url"), (), False)).collect()


def test_quantile_bounds(spark):
    df = spark.createDataFrame([(1.0,)] * 3 + [(2.5,)] * 2 + [(9.1,)] * 4, "v double")
    assert tuple(filters.quantile_bounds(df, "v").first()) == (1.0, 9.1)


def test_survivors_of_a_chain(spark):
    ids = spark.createDataFrame([(i,) for i in range(1, 8)], "doc_id bigint")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (5, 6), (4, 6)], "id_a bigint, id_b bigint")
    assert sorted(r.doc_id for r in dedup.greedy_survivors(ids, pairs).collect()) == [1, 3, 4, 7]


def test_bands_divide():
    with pytest.raises(ValueError):
        dedup.bands(None, 15, 128)


def test_packing(spark):
    df = spark.createDataFrame([(1, [1] * 5), (2, [2] * 6), (3, [3] * 7), (4, [])], "doc_id bigint, input_ids array<int>")
    assert [r.tokens for r in mixing.pack(df, 4).orderBy("block_id").collect()] == [[1] * 4, [1, 2, 2, 2], [2, 2, 2, 3], [3] * 4]
    assert sum(len(r.tokens) for r in mixing.pack(df, 4, False).collect()) == 18


def test_split_is_a_partition(spark):
    got = mixing.split(spark.range(2000).withColumnRenamed("id", "doc_id")).groupBy("split").count().collect()
    n = {r.split: r["count"] for r in got}
    assert sum(n.values()) == 2000 and 1500 < n["train"] < 1700


def test_running_total_with_nulls(spark):
    df = spark.createDataFrame([(i,) for i in range(500, 0, -1)] + [(None,)], "k bigint").repartition(5)
    got = {r.k: r.n for r in ordering.with_row_number(df, "k", "n", 70).collect()}
    assert got == {None: 1} | {i: i + 1 for i in range(1, 501)}
    assert ordering.with_row_number(df.where("false"), "k", "n").count() == 0


def test_ranks_of_strings_ties_and_weights(spark):
    rows = [(f"id{i:03d}", i % 7, "t") for i in range(300)] + [("id005", 3, "again"), ("id005", 1, "once more"), (None, 4, "null"), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, w int, _n string").repartition(4)
    got = ordering.with_row_number(df, "k", "n", 40)
    assert got.columns == [*df.columns, "n"] or set(got.columns) == {"k", "w", "n"}
    assert sorted(r.n for r in got.collect()) == list(range(1, 305))
    assert [r.k for r in got.orderBy("n").collect()] == sorted([k for k, *_ in rows], key=lambda k: (k is not None, k or ""))
    total = 0
    for r in ordering.with_running_total(df.drop("_n"), "k", "at", F.col("w"), 40).orderBy("at", "w").collect():
        assert r["at"] == total
        total += r.w
    two = ordering.with_row_number(df.where("k is not null").drop("_n"), ["w", "k"], "n", 40).orderBy("n").collect()
    assert [(r.w, r.k) for r in two] == sorted((w, k) for k, w, _ in rows if k is not None)


def test_reasons_keep_every_row(spark):
    docs = spark.createDataFrame([(1, "a", "src0"), (1, "a", "src0"), (1, "b", "src7"), (None, None, "src0")], "doc_id bigint, text string, source string")
    got = curation.reasons(docs, ("src7",))
    assert got.columns == ["doc_id", "text", "source", "reason"]
    assert sorted((str(r.doc_id), r.reason) for r in got.collect()) == [("1", "gopher_quality"), ("1", "gopher_quality"), ("1", "url"), ("None", "gopher_quality")]
    assert filters.language_scores(docs, {"en": ("a",)}).count() == 4


def test_chain_on_odd_rows(spark):
    text = "The cat is on the mat and it has been there for a while. It was not the only one of them to be so. That is what we have with it."
    docs = spark.createDataFrame([(1, text, "x", "http://ok.org/1"), (1, text, "x", "http://bad.org/1"), (2, None, None, None), (3, "", "x", "not a url"), (4, text, "x", "http://www.bad.org")], "doc_id bigint, text string, reason string, link string")
    block = spark.createDataFrame([("bad.org",)], "domain string")
    judge = lambda d: curation.judge(d.withColumnRenamed("reason", "why"), F.col("link"), block, {"en": ("the", "is")}, ("en",), {"en": {"the cat": 5}}, quality={"low": 5}, flagged_keep=0, flagged_threshold=1.0)
    got = judge(docs)
    assert sorted((r.doc_id, r.link or "", r.reason) for r in got.collect()) == [(1, "http://bad.org/1", "url"), (1, "http://ok.org/1", "kept"), (2, "", "language"), (3, "not a url", "language"), (4, "http://www.bad.org", "url")]
    assert judge(docs.limit(0)).count() == 0


def test_repetition_against_counting(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["aa", "b", "ccc", "d"]) for _ in range(rng.randrange(0, 40)))) for i in range(120)] + [(900, ""), (901, "x"), (902, "é é é é é é é é é é é é")]
    got = {r.doc_id: r for r in filters.gopher_repetition(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for i, t in docs:
        w = t.split()
        for n in (2, 3, 4):
            counts = Counter(zip(*(w[k:] for k in range(n))))
            most = max(counts.values(), default=0)
            want = 0 if most < 2 else most * max(len(" ".join(g)) for g, c in counts.items() if c == most)
            assert got[i][f"top_{n}"] == (round(want / len(t), 6) if t else 0)
        for n in range(5, 11):
            counts = Counter(zip(*(w[k:] for k in range(n))))
            covered = {p for k in range(len(w) - n + 1) if counts[tuple(w[k : k + n])] > 1 for p in range(k, k + n)}
            chars = sum(map(len, w))
            assert got[i][f"dup_{n}"] == (round(sum(len(w[p]) for p in covered) / chars, 6) if chars else 0)


def test_repetition_looks_at_what_shorter_ones_left():
    import time

    import numpy as np
    import pyarrow as pa

    words = [[f"w{i}" for i in range(k, k + 400)] for k in range(4000)]
    began = time.time()
    got = filters.ngram_measures((2, 3, 4), (5, 6, 7, 8, 9, 10)).func(pa.array([*words, [], None, ["a", "b"] * 9])).to_pylist()
    assert time.time() - began < 4
    assert got[0] == {"top_2": 0, "top_3": 0, "top_4": 0} | {f"dup_{n}": 0 for n in range(5, 11)} | {"chars": sum(map(len, words[0]))}
    assert {x["chars"] for x in got[-3:-1]} == {0} and got[-1]["dup_10"] == 18 and got[-1]["top_2"] == 27
    assert np.sum([x["dup_5"] for x in got]) == 18


def test_normalizers(spark):
    rows = spark.createDataFrame([("a1", "T", '{"author": "X", "year": "1900"}', "Title\nthe cat\nsat.\nNext"), ("a2", None, "no json", None)], normalizers.SOURCES["gutenberg_en"].schema)
    got = {r.metadata["dataset_generated_id"]: r for r in normalizers.normalize(rows, "gutenberg_en").collect()}
    assert all(r.id % 1000 == 10 for r in got.values()) and len({r.id for r in got.values()}) == 2
    assert got["a1"].text == "the catsat.\nNext" and got["a1"].url is None
    assert got["a1"].metadata == {"url": "https://gutenberg-en.example/a1", "title": "T", "author": "X", "year": "1900", "origin": "gutenberg_en", "dataset_generated_id": "a1"}
    assert got["a2"].text is None and got["a2"].metadata["title"] is None
    mtet = normalizers.normalize(spark.createDataFrame([("p", "r")], normalizers.SOURCES["mtet"].schema), "mtet").first()
    assert mtet.url == f"https://mtet.example/{mtet.id}" and set(mtet.metadata) == {"origin", "dataset_generated_id"}
    for name, source in normalizers.SOURCES.items():
        assert normalizers.normalize(spark.createDataFrame([], source.schema), name).columns == ["id", "text", "url", "metadata"]
    with pytest.raises(KeyError):
        normalizers.language_of("europarl_en")


def test_perplexity(spark):
    import math

    docs = spark.createDataFrame([(1, "a a b"), (2, "z"), (3, ""), (4, None)], "doc_id bigint, text string")
    model = filters.unigram_model(docs.where("doc_id = 1"))
    # counts 2 and 1, two words and the unknown one: (c + 1) / (3 + 2 + 1)
    want = {1: math.exp(-(2 * math.log(3 / 6) + math.log(2 / 6)) / 3), 2: 6.0}
    for hot in (0, 1, 10):
        assert {r.doc_id: round(r.ppl, 9) for r in filters.perplexity(docs, model, hot).collect()} == {k: round(v, 9) for k, v in want.items()}
    kept = curation.perplexity_filter(docs, model, F.lit(None).cast("string"))
    assert {r.doc_id: r.keep for r in kept.collect()} == dict.fromkeys((1, 2, 3, 4), True)


def test_perplexity_filter_leaves_out_texts_without_words(spark, tmp_path):
    rows = [(1, "a a b", "en", "src1"), (2, "z", "de", "src2"), (3, "", "en", "src3"), (4, None, "en", "src4"), (5, " \n", "en", "src5")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(r.doc_id for r in QUERIES["perplexity_filter"](spark, str(tmp_path)).collect()) == [1, 2]


def test_perplexity_in_any_order(spark):
    rng = random.Random(5)
    words = [f"w{min(int(rng.paretovariate(0.4)), 900)}" for _ in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(words, len(words)))) for i in range(40)], "doc_id bigint, text string")
    model = filters.unigram_model(docs.where("doc_id = 0"))
    # one bag of words, so one value to the last bit, by either way of meeting the model
    values = {r.ppl for hot, limit in ((10, 10_000), (50, 0), (0, 0)) for r in filters.perplexity(docs, model, hot, limit).collect()}
    assert len(values) == 1


def test_substring_dedup_cuts_the_text(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"one\n{shared} end"), (2, f"  two {shared}\n\nlast  "), (3, "short"), (4, None), (5, f"{shared} {shared}")], "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_words, r.n_left, r.keep) for r in dedup.substring_dedup(docs).collect()}
    assert got[1] == (f"one\n{shared} end", 62, 62, True) and got[3] == ("short", 1, 1, False)
    assert got[2] == ("  two\n\nlast", 62, 2, False) and got[4] == (None, 0, 0, False) and got[5] == ("", 120, 0, False)


def test_spans_against_brute_force(spark):
    rng, k = random.Random(9), 20
    docs = [(i, " ".join(rng.choice("ab" if i % 3 else "abcdefgh") for _ in range(rng.randrange(0, 90)))) for i in range(60)]
    docs += [(100 + i, t) for i, (_, t) in enumerate(docs[:9])] + [(200, "x " * 70), (201, "y " + docs[0][1] + " z"), (202, None), (203, "")]
    seen, gone = set(), {}
    for i, t in sorted(docs):
        w = (t or "").split()
        for p in range(len(w) - k + 1):
            g = tuple(w[p : p + k])
            if g in seen:
                gone.setdefault(i, set()).update(range(p, p + k))
            seen.add(g)
    got = {}
    for r in dedup.repeated_spans(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), k).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start, r.stop))
    assert got == gone


def test_few_anchors_for_all_windows():
    import numpy as np

    h = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    h[9000:9100] = h[100:200]
    v, start, stop = dedup.anchors(h, 50, 16)
    assert (start[0], stop[-1]) == (0, 20_000 - 49) and (start[1:] == stop[:-1]).all() and len(v) < 20_000 / 15
    of = np.repeat(v, stop - start)
    assert (of[9000:9051] == of[100:151]).all()
    v, counts = np.unique(v, return_counts=True)
    assert set(of[9000:9051]) == set(v[counts > 1])


@pytest.mark.parametrize("f", [mixing.tokenize, dedup.minhash, dedup.repeated_spans])
def test_texts_travel_in_bounded_batches(spark, f):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    f(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
    assert spark.conf.get(key) == str(shared.ARROW_BYTES)


def test_packing_takes_each_text_apart_once(spark):
    import pandas as pd

    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        seen.add(len(texts))
        return texts.map(lambda x: [len(w) for w in x.split()])

    docs = spark.createDataFrame([(i, "a bb ccc") for i in range(50)], "doc_id bigint, text string")
    assert mixing.pack(mixing.tokenize(docs, ids=ids), 10).count() == 25
    assert seen.value == 50


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_vocabulary_is_counted_once(spark):
    # the one that is left takes the counted tokens apart
    assert QUERIES["vocab_lang"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_files_and_resources(spark, tmp_path):
    path = str(tmp_path / "r.json")
    assert files.load_resource(path, {}) == {}
    files.save_resource(path, {"é": [1]})
    assert files.load_resource(path) == {"é": [1]} and '\n  "é"' in open(path).read()
    (tmp_path / "i.json").write_text('[{"instruction": "a", "input": "b", "output": "c"}, {"input": "d", "output": "e"}]')
    assert sorted(map(tuple, files.read_instructions(spark, str(tmp_path / "i.json")).collect())) == [("a", "b", "c"), ("d", None, "e")]
    spark.range(20).withColumnRenamed("id", "block_id").write.parquet(str(tmp_path / "b"))
    order = [r.block_id for r in files.read_blocks(spark, str(tmp_path / "b"), 1).collect()]
    assert sorted(order) == list(range(20)) and order != sorted(order) and order == [r.block_id for r in files.read_blocks(spark, str(tmp_path / "b"), 1).collect()]


def test_csv_keeps_every_value(spark, tmp_path):
    texts = [" lead", "trail \n", "\n\nx\r\ny\rz", 'q"u""o,te" \\" \\', "", None, " \t ", "\r", "nul\x00l\x01", "\\N", '""']
    rows = [(i, t, u) for i, (t, u) in enumerate(zip(texts, texts[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, QUERIES["csv_roundtrip"](spark, str(tmp_path)).collect())) == rows


def test_files_of_one_address(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a" * 2000), (2, "u", "b" * 2500), (4, "u", "c" * 3000), (6, "v", "d")], "page_id bigint, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.path, r.n_bytes, r.kind) for r in QUERIES["files_to_compress"](spark, str(tmp_path)).collect())
    assert got == [("u", 2000, "unknown"), ("u", 2500, "scanned"), ("u", 3000, "scanned")]


def test_no_folder_of_its_own_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda k, d: d)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Cluster)


@pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken"), reason="no vocabulary")
def test_real_tokens(spark):
    docs = spark.createDataFrame([(1, "The cat's 12 mats"), (2, "")], "doc_id bigint, text string")
    ids = mixing.bpe_ids("/opt/tokenizers/byte_bpe_50k.tiktoken")
    t = mixing._encoding("/opt/tokenizers/byte_bpe_50k.tiktoken", mixing.GPT2_PATTERN)
    got = mixing.tokenize(docs, ids=ids)
    assert {r.doc_id: r.input_ids for r in got.collect()} == {1: [1, *t.encode_ordinary("The cat's 12 mats"), 2], 2: [1, 2]}
    with pytest.raises(ValueError):
        mixing.tokenize(got)


@pytest.mark.skipif(not os.path.isdir(DATA) or not os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken"), reason="no test tables")
def test_token_stats(spark, duck):
    t = mixing._encoding("/opt/tokenizers/byte_bpe_50k.tiktoken", mixing.GPT2_PATTERN)
    n, words = Counter(), Counter()
    for lang, text in duck.sql("SELECT lang, text FROM documents").fetchall():
        n[lang] += len(t.encode_ordinary(text)) + 2
        words[lang] += len(text.split())
    got = {r.lang: (r.tokens, r.fertility) for r in QUERIES["token_stats"](spark, DATA).collect()}
    assert got == {k: (n[k], round(n[k] / words[k], 6)) for k in n}


def test_merges_with_an_alphabet_and_a_prefix(spark):
    docs = spark.createDataFrame([(1, "low low low lox qq")], "doc_id bigint, text string")
    assert vocabulary.train_merges(docs, 1, alphabet=3) == [("l", "o")]
    assert vocabulary.train_merges(docs, 2, alphabet=2, prefix="Ġ") != vocabulary.train_merges(docs, 2)
    assert vocabulary.train_merges(docs, 3, dropout=1.0) == []


def test_vocabulary(spark):
    new = spark.createDataFrame([(f"từ{'a' * i}", 300 - i) for i in range(300)], "token string, n bigint")
    assert vocabulary.merge(new, spark.createDataFrame([("x",)], "token string")).count() == 256
    empty_token = vocabulary.by_language(spark.createDataFrame([("123", 5), ("abc", 5)], "token string, n bigint"), spark.createDataFrame([("x",)], "syllable string"))
    assert {r.token: r.in_language for r in empty_token.collect()} == {"123": True, "abc": False}


def test_merges(spark):
    docs = spark.createDataFrame([(1, "low low lower lowest")], "doc_id bigint, text string")
    assert vocabulary.train_merges(docs, 2) == [("l", "o"), ("lo", "w")]


def test_open_turn(spark):
    df = spark.createDataFrame([("user", "hi"), ("assistant", None)], "role string, text string")
    assert [r[0] for r in df.select(T.chat_block(F.col("role"), F.col("text"))).collect()] == ["<|im_start|>user\nhi<|im_end|>\n", "<|im_start|>assistant\n"]
