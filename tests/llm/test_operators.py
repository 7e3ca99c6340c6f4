"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, and brute-force versions."""

import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from corpusloom.llm import exact_dedup, license_scan, lm_scoring, ngram_join, packing, piece_coding, quality_rules, token_output, toxicity, warc

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the cat sat on a mat and then it ran to see the other dog near old house by river where we all met".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def rows():
    rng = random.Random(1)
    out = [(i, text(rng, rng.randrange(1, 120)), "en", "s", 1) for i in range(30)]
    base = text(rng, 100)
    words = base.split()
    for k in range(6):
        w = list(words)
        w[10 * k] = "changed"
        out.append((100 + k, " ".join(w), "en", "s", 1))
    out += [(200 + k, base, None, None, None) for k in range(4)]
    out += [(200, base, "en", "s", 1), (300, None, "en", "s", 1), (301, None, None, None, None), (302, "", "en", "s", 0), (303, " \n\t ", "en", "s", 4), (None, "without an id", "en", "s", 1)]
    out.append((400, text(rng, 30_000), "de", "s", 1))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOC).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], DOC)


def clashing(docs):
    from pyspark.sql import functions as F

    out = docs
    for c in ("_digest", "_salt", "_text", "_order", "salt", "item", "batch", "fragment", "size", "word", "reason", "keep", "v", "_in", "_gone", "head", "ids"):
        out = out.withColumn(c, F.lit("clash"))
    return out


def test_exact_dedup(spark, docs):
    got = {(r.doc_id, r.n_copies) for r in exact_dedup.exact_dedup(docs, 2).collect()}
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[t].append(i)
    assert got == {(min((x for x in g if x is not None), default=None), len(g)) for g in groups.values()}
    kept = exact_dedup.drop_copies(clashing(docs))
    assert kept.columns == clashing(docs).columns and kept.count() == len(groups)
    assert {tuple(r)[:5] for r in kept.collect()} <= set(rows())
    assert exact_dedup.drop_copies(empty(spark)).count() == exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_drop_copies_with_a_map(spark):
    df = spark.createDataFrame([(2, "a", {"k": "v"}), (1, "a", {"k": "w"}), (3, None, None)], "doc_id bigint, text string, m map<string,string>")
    assert sorted((r.doc_id, r.m) for r in exact_dedup.drop_copies(df).collect()) == [(1, {"k": "w"}), (3, None)]


def brute_classes(data, threshold, n):
    """{doc_id: (class_id, n_links)} by comparing every two documents; doc_ids have one text each."""
    sets = {}
    for i, t, *_ in data:
        if i is not None:
            w = (t or "").lower().split()
            k = min(n, len(w))
            sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    links, parent = Counter(), {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j in sorted(sets):
            s, t = sets[i], sets[j]
            if i < j and s and len(s & t) / len(s | t) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                if x != y:
                    parent[y] = x
    return {i: (find(i), links[i]) for i in sets}


def classes(df):
    got = df.collect()
    assert len(got) == len({r.doc_id for r in got})
    return {r.doc_id: (r.class_id, r.n_links) for r in got}


@pytest.mark.parametrize("threshold,n,per,small,block", [(0.5, 5, 500, 64, 512), (0.5, 5, 500, 1, 2), (0.8, 3, 4_000_000, 2, 3), (0.3, 1, 2000, 64, 512), (0.3, 1, 2000, 3, 5)])
def test_ngram_join(docs, threshold, n, per, small, block):
    got = ngram_join.ngram_jaccard_join(clashing(docs), n, threshold, per, small, block)
    assert classes(got) == brute_classes(rows(), threshold, n)


@pytest.mark.parametrize("small", [1, 64])
def test_ngram_join_of_repeated_batches(docs, small):
    """Every partition stands twice, so whole batches have the same rows."""
    assert classes(ngram_join.ngram_jaccard_join(docs.union(docs), per_fragment=500, small=small)) == brute_classes(rows(), 0.5, 5)


def test_ngram_join_of_long_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(1 << 40)}" for _ in range(300_000)]
    near = [*words[:150_000], "other", *words[150_001:]]
    data = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:140_000]))]
    sets = [set(ngram_join.ngram_set(t).tolist()) for _, t in data]
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(2)
    j = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert len(sets[0]) == 299_996 and round(j, 6) == 0.999967
    for small in (1, 64):
        assert classes(ngram_join.ngram_jaccard_join(df, 5, j, small=small)) == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
        assert classes(ngram_join.ngram_jaccard_join(df, 5, j + 1e-7, small=small)) == {1: (1, 0), 2: (2, 0), 3: (3, 0)}


def test_ngram_join_sends_few_bytes_a_member():
    """Every document twice, so that all members are shared and everything comes back; the widest case for the disks."""
    rng = random.Random(5)
    texts = [text(rng, 400) for _ in range(150)] * 2
    batch = ngram_join.pa.RecordBatch.from_arrays([ngram_join.pa.array(range(300)), ngram_join.pa.array(texts)], names=["doc_id", "text"])
    members = sum(len(ngram_join.ngram_set(t)) for t in texts)
    sent = list(ngram_join._cut(5, 4, 40_000, 60_000)([batch]))
    assert len(sent) == 3
    sent = ngram_join.pa.Table.from_batches(sent).sort_by("fragment")
    column = sent["fragment"].to_numpy()
    shared = ngram_join.pa.concat_tables([ngram_join._share(sent.filter(ngram_join.pa.array(column == f))) for f in sorted(set(column.tolist()))])
    column = shared["batch"].to_numpy()
    kept = ngram_join.pa.concat_tables([ngram_join._gather(0.5)(shared.filter(ngram_join.pa.array(column == b))) for b in sorted(set(column.tolist()))])

    def size(table):
        return sum(len(x.as_py() or b"") for c, t in zip(table.column_names, table.schema.types) if t == "binary" for x in table[c]) / members

    assert sum(kept["n_shared"].to_pylist()) == members
    names = {i: m.tolist() for i, m in zip(kept["doc_id"].to_pylist(), ngram_join._members(kept["members"]))}
    assert all(names[i] == names[i + 150] and len(set(names[i])) == len(ngram_join.ngram_set(texts[i])) for i in range(150))
    assert size(sent) < 11 and size(shared) < 8 and size(kept) < 6.1


@pytest.mark.parametrize("low,top", [(5, 1 << 48), (2, 1 << 21), (2, 3)])
def test_packed_numbers(low, top):
    rng = np.random.default_rng(1)
    for n in (1, 7, 1000):
        x = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        assert (ngram_join._unpack(ngram_join._pack(x, low), n, low) == x).all()
        for docs in (1, 2, 700, 60_000):
            o = rng.integers(0, docs, n).astype(np.uint16)
            assert (ngram_join._unpack_bits(ngram_join._pack_bits(o, ngram_join._width(docs)), n, ngram_join._width(docs)) == o).all()


def test_ngram_join_leaves_no_large_tables(spark, docs):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder, before = Path(ngram_join.shared_dir(spark).removeprefix("file://")), spark.conf.get(cleanup)
    known = set(folder.iterdir())
    assert classes(ngram_join.ngram_jaccard_join(clashing(docs))) == brute_classes(rows(), 0.5, 5)
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - known}
    assert "distinct-sets" in left and not left & {"ngram-replies", "ngram-sets"}
    assert spark.conf.get(cleanup) == before


def test_ngram_join_with_several_texts_of_a_doc_id(spark):
    a, b = "one two three four five six seven", "eins zwei drei vier fuenf sechs sieben"
    df = spark.createDataFrame([(1, a), (2, b), (3, a), (3, b), (4, "quite another text")], "doc_id bigint, text string")
    assert classes(ngram_join.ngram_jaccard_join(df)) == {1: (1, 1), 2: (1, 1), 3: (1, 2), 4: (4, 0)}


def test_one_of_each_group_stays(spark, docs):
    kept = ngram_join.keep_one_each(clashing(docs))
    assert kept.columns == clashing(docs).columns
    want = brute_classes(rows(), 0.5, 5)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, *_ in rows() if i is None or want[i][0] == i)
    assert ngram_join.keep_one_each(empty(spark)).count() == ngram_join.ngram_jaccard_join(empty(spark)).count() == 0


def test_connected_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51)], "doc_a bigint, doc_b bigint")
    for one_task in (0, 100):
        assert sorted((r.doc_id, r.head) for r in ngram_join.connected(pairs, one_task).collect()) == [(i, 0) for i in range(1, 21)] + [(51, 50)]
    assert ngram_join.connected(pairs.where("false")).count() == 0


def test_word_hashes_in_blocks(monkeypatch):
    data = ("ein Wörtchen\tund " * 50).encode()
    whole = ngram_join.word_hashes(data)
    monkeypatch.setattr(ngram_join, "_BLOCK", 37)
    assert (ngram_join.word_hashes(data) == whole).all() and len(set(whole.tolist())) == 3


def best_fit_count(items, capacity):
    rooms = []
    for s in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


def optimum(items, capacity):
    """The smallest number of bins by trying everything (few items only)."""
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best and i < len(items):
            return
        if i == len(items):
            best = min(best, len(rooms))
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i]:
                rooms[k] -= items[i]
                place(i + 1, rooms)
                rooms[k] += items[i]
        rooms.append(capacity - items[i])
        place(i + 1, rooms)
        rooms.pop()

    place(0, [])
    return best


def test_packing_solver():
    rng = random.Random(4)
    for _ in range(200):
        c = rng.choice([7, 12, 30])
        items = [rng.randrange(1, c) for _ in range(rng.randrange(1, 9))]
        counts = Counter(items)
        assert sum(n for _, n in packing.best_fit(counts, c)) == best_fit_count(items, c)
        patterns = packing.pack_sizes(counts, c)
        used = Counter()
        for content, n in patterns:
            assert sum(content) <= c
            for s in content:
                used[s] += n
        assert used == counts
        # what dominance fixes never costs a bin
        fixed, left = packing.reduce_instance(counts, c)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + optimum(rest, c) == optimum(items, c)


def test_reduction_goes_on_past_an_irreducible_item():
    # beside 7 three items fit and none fills the window, so it has no dominating set; 6 and 4 do fill one
    assert packing.reduce_instance({7: 1, 6: 1, 4: 1, 1: 4}, 10) == ([((6, 4), 1)], {7: 1, 1: 4})
    rng = random.Random(5)
    for _ in range(300):
        c = rng.choice([12, 30, 100])
        counts = Counter(rng.randrange(1, c) for _ in range(rng.randrange(1, 60)))
        fixed, left = packing.reduce_instance(counts, c)
        used = Counter(left)
        for content, n in fixed:
            assert sum(content) <= c
            for s in content:
                used[s] += n
        assert used == counts
        # no item that is left has a partner which fills its window
        assert not any(c - s in left and (s != c - s or left[s] > 1) for s in left)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, docs, capacity):
    got = packing.best_fit_packing(clashing(docs), capacity, 3).collect()
    sizes = Counter()
    for r in got:
        sizes[r.doc_id] += r.n_tokens
    want = Counter()
    for i, t, *_ in rows():
        want[i] += len((t or "").split())
    assert sizes == +want
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append((r.bin_offset, r.n_tokens))
    assert sorted(bins) == list(range(len(bins)))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    items = [len((t or "").split()) for _, t, *_ in rows()]
    assert len(bins) <= sum(n // capacity for n in items) + best_fit_count([n % capacity for n in items if n % capacity], capacity) + 1
    assert packing.best_fit_packing(empty(spark)).count() == 0


def test_quality_rules(spark, docs):
    got = quality_rules.quality_verdicts(clashing(docs))
    assert got.count() == len(rows())
    by = {r.doc_id: r for r in got.collect()}
    assert by[300].reason == by[302].reason == by[303].reason == "min_words" and by[0].n_words == len(rows()[0][1].split())
    kept = quality_rules.keep_good(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got.collect() if r.keep)
    assert quality_rules.keep_good(empty(spark)).count() == 0
    bad = spark.createDataFrame([(1, "WHY!! OH!! WHY!!"), (2, "a$$$ b%%% c&&&"), (3, "The cat is on the mat.")], "doc_id bigint, text string")
    assert {r.doc_id: r.reason for r in quality_rules.quality_verdicts(bad).collect()} == {1: "shout_ratio", 2: "symbol_ratio", 3: None}
    assert quality_rules.keep_good(bad, [("n", "n_words", ">", None, 0)]).count() == 3


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice(["the", "tion", "er", "and", "re", "st"]) for _ in range(rng.randrange(1, 4))) for _ in range(3000)]
    insults = ["blorfing", "snarkle", "gribbly", "wumpus"]
    docs, labels = [], []
    for i in range(400):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(insults))
        docs.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(toxic)))
    truth = dict(labels)
    return spark.createDataFrame(docs + [(900, None, "en", "s", 0), (901, "", "en", "s", 0)], DOC), spark.createDataFrame([*labels[:250], (3, 0), (77777, 1), (None, 1), (4, None)], "doc_id bigint, toxic int"), truth


def test_toxicity_on_documents_without_labels(labelled):
    docs, labels, truth = labelled
    got = {r.doc_id: r.is_toxic for r in toxicity.toxicity_scores(clashing(docs), labels).collect()}
    held = [i for i in truth if i >= 250]
    assert sum(got[i] == bool(truth[i]) for i in held) >= 0.97 * len(held)
    assert not got[900] and not got[901]
    kept = toxicity.keep_ordinary(clashing(docs), labels)
    assert kept.columns == clashing(docs).columns and {r.doc_id for r in kept.collect()} == {i for i, x in got.items() if not x}


def test_toxicity_against_brute_force(spark, labelled):
    """Every window of every text compressed on its own, with words and windows found another way; repeated rows, ties and long texts too."""
    import re

    import xxhash
    import zstandard

    docs, labels, _ = labelled
    model = toxicity.train(docs, labels)
    long = " ".join(["the tion blorfing and"] * 9000)
    more = spark.createDataFrame([(1000, long), (1001, "Blorfing, SNARKLE! gribbly-wumpus 7"), (1001, "Blorfing, SNARKLE! gribbly-wumpus 7"), (1002, " \n 12 ___ "), (None, "wumpus")], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(more)

    def size(dictionary, data):
        log = max(13, len(model.toxic).bit_length())
        setting = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=32 * 8, dict_size=len(model.toxic), write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS, min_match=6, strategy=zstandard.STRATEGY_LAZY, hash_log=log, chain_log=log + 1,
            search_log=7, window_log=max(17, log + 1),
        )
        return len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=setting).compress(data))

    want = Counter()
    seen = {}
    for i, t in ((r.doc_id, r.text) for r in both.collect()):
        words = [w for w in re.split(r"[\W\d_]+", (t or "").lower()) if w]
        windows = [b"".join(xxhash.xxh64_digest(w.encode()) for w in words[k : k + 32]) for k in range(0, len(words), 32)]
        for w in windows:
            if w not in seen:
                seen[w] = size(model.ordinary, w) - size(model.toxic, w)
        d = [seen[w] for w in windows]
        hits = sum(x >= model.threshold for x in d)
        want[i, max([0, *d]), len(d), hits, hits > 0] += 1
    got = toxicity.toxicity_scores(both, labels).collect()
    assert Counter(tuple(r) for r in got) == want
    assert any(r.doc_id == 1000 and r.is_toxic and r.n_windows == 1125 for r in got)


def test_toxicity_labels_without_documents_take_no_place(spark, labelled):
    docs, labels, truth = labelled
    strange = spark.range(10_000, 40_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    few = toxicity.train(docs, labels.unionByName(strange), sample=250)
    assert few == toxicity.train(docs, labels, sample=250) and few is not None
    assert toxicity.train(docs, labels, sample=3) is None
    # a byte bound that only the first document of a class keeps to
    assert toxicity.train(docs, labels, sample_bytes=1) is None


def test_toxicity_of_unseen_words_with_a_known_beginning(labelled):
    docs, labels, _ = labelled
    score = toxicity.train(docs, labels).scorer()
    assert score("the blorfly and a snarkout") == (0, 1, 0) and score("blorfing snarkle")[2] == 1


def test_toxicity_without_labels(spark, labelled):
    docs, labels, _ = labelled
    assert not any(r.is_toxic for r in toxicity.toxicity_scores(docs, labels.limit(0)).collect())
    assert toxicity.toxicity_scores(empty(spark), labels).count() == 0


def test_warc(spark):
    import hashlib

    pages = spark.createDataFrame([(1, "http://a", "é" * 40_000), (2, None, None), (3, "http://b", ""), (4, "http://c", "WARC/1.1\r\n\r\nx" * 3), (4, "http://c", "WARC/1.1\r\n\r\nx" * 3)], "page_id bigint, url string, html string").repartition(2)
    got = defaultdict(list)
    for r in warc.warc_chunks(pages, 1000).orderBy("record_id", "chunk_no").collect():
        got[r.record_id].append(r)
    for i, body in ((1, ("é" * 40_000).encode()), (2, b""), (3, b"")):
        parts = got[f"<urn:page:{i}>"]
        assert b"".join(bytes(p.payload) for p in parts) == body and [p.is_last for p in parts] == [False] * (len(parts) - 1) + [True]
        assert all(p.digest == hashlib.sha256(body[: p.byte_start + p.n_bytes]).hexdigest() for p in parts)
    assert got["<urn:page:2>"][0].url is None and len(got["<urn:page:4>"]) == 2
    assert warc.warc_chunks(pages.limit(0)).count() == 0


def test_warc_identifiers_and_urls_of_any_kind(spark):
    odd = ["a\r\nX: y", " \t", "a%0Ab", "100%", " edge ", "\ttab", "é\n漢", "plain", "", "a:b>c", None]
    pages = spark.createDataFrame([(x, y, "p", "clash") for x in odd for y in odd], "page_id string, url string, html string, record_id string")
    got = Counter((r.record_id, r.url, bytes(r.payload)) for r in warc.warc_chunks(pages).collect())
    assert got == Counter((f"<urn:page:{x or ''}>", y, b"p") for x in odd for y in odd)


def test_warc_leaves_the_percent_signs_of_others():
    import io

    record = b"WARC/1.0\r\nWARC-Record-ID: <a%20b>\r\nWARC-Target-URI: http://x/%2520\r\nContent-Length: 1\r\n\r\nz\r\n\r\n"
    assert [r[:2] for r in warc.chunks(io.BytesIO(record), False, 10)] == [("<a%20b>", "http://x/%2520")]


def test_warc_stream_of_many_members(tmp_path):
    import gzip
    import io

    record = b"WARC/1.0\r\nWARC-Record-ID: <x>\r\nContent-Length: 300000\r\n\r\n" + b"z" * 300_000 + b"\r\n\r\n"
    members = gzip.compress(record) * 3
    got = list(warc.chunks(io.BytesIO(members), True, 100_000))
    assert [r[2] for r in got] == [0, 1, 2] * 3 and sum(r[4] for r in got) == 900_000
    for cut in (members[:-30], gzip.compress(record[:-200_000])):
        with pytest.raises(ValueError):
            list(warc.chunks(io.BytesIO(cut), True, 100_000))
    with pytest.raises(ValueError):
        list(warc.chunks(io.BytesIO(b"WARC/1.0\r\n\r\n"), False, 10))


def test_byte_code():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1000):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_output.encode(v)
        assert len(control) == -(-n // 4) and (token_output.decode(control, data, n) == v).all()


def test_token_output(spark, docs):
    encoded, ranks = token_output.encode_corpus(clashing(docs))
    t = token_output.tokenizer(token_output.VOCABULARY)
    want = sorted((str(i), None if x is None else t.encode_ordinary(x)) for i, x, *_ in rows())
    assert sorted((str(r.doc_id), r.token_ids) for r in token_output.decode_corpus(encoded, ranks).collect()) == want
    counts = Counter(x for _, ids in want for x in ids or [])
    assert [r.token_id for r in ranks.orderBy("rank").collect()] == sorted(counts, key=lambda i: (-counts[i], i))
    assert token_output.encode_corpus(empty(spark))[0].count() == 0


def test_token_ids_of_long_white_space():
    t = token_output.tokenizer(token_output.VOCABULARY)
    for run in (" " * 6000, "\n" * 5000, " \n" * 4000, "\u3000\t" * 3000):
        for x in ("abc" + run, run + "x", "abc" + run + " x" + run + "?\n", run, "1" + run + "漢"):
            assert token_output.token_ids(t, x) == t.encode_ordinary(x)
    assert t.decode(token_output.token_ids(t, "a" + " " * 1_000_000 + "b")) == "a" + " " * 1_000_000 + "b"


def best_apart(notice, folded):
    """The best match of the whole text, then of what lies before and after it, and so on, without seeds."""
    todo, out = [(0, len(folded))], []
    while todo:
        a, b = todo.pop()
        if m := notice.pattern.search(folded[a:b]):
            out.append((a + m.start(), sum(m.fuzzy_counts)))
            todo += [(a, a + m.start()), (a + m.end(), b)]
    return sorted(out)


def test_license_scan_of_dense_notices(spark):
    notices = [license_scan.Notice(k, v, 3) for k, v in license_scan.NOTICES.items()]
    t = "Released under teh MIT License " * 400
    got = license_scan.find_notices(t, notices)
    assert [(m[0], m[3]) for m in got] == [("MIT", 2)] * 400 and all(a[2] <= b[1] for a, b in zip(got, got[1:]))
    # ties: two notices that lie equally near, repeated rows, a seed's words on their own
    pair = {"A": "licence alpha one", "B": "licence alphb one"}
    df = spark.createDataFrame([(1, "the licence alphc one"), (1, "the licence alphc one"), (2, "licence licence alpha alpha"), (3, "")], "doc_id bigint, text string")
    assert [tuple(r) for r in license_scan.scan_licenses(df, pair, 1).collect()] == [(1, "A", 4, 21, 1, "licence alphc one")] * 2


def test_license_scan(spark, docs):
    rng = random.Random(3)
    notices = [license_scan.Notice(k, v, 3) for k, v in license_scan.NOTICES.items()]
    for _ in range(40):
        t = text(rng, 60)
        for n in notices[:5]:
            z = list(n.text)
            for _ in range(rng.randrange(5)):
                k = rng.randrange(len(z))
                z[k : k + 1] = rng.choice([["q"], [], [z[k], "x"]])
            p = rng.randrange(len(t))
            t = t[:p] + "\n" + "".join(z).title().replace(" ", rng.choice([" ", "  ", "\n"])) + " " + t[p:]
        folded, _ = license_scan._folded(t)
        for n in notices[:5]:
            assert [(a, edits) for a, _, edits in n.matches(folded)] == best_apart(n, folded)
    assert license_scan.scan_licenses(docs).count() == license_scan.scan_licenses(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "İ  Relaesed under\nthe MIT  License. Licensed under CC BY-SA 4.0.", 1), (2, None, 2)], "doc_id bigint, text string, license int")
    got = sorted((r.license, r.n_edits, r.matched) for r in license_scan.scan_licenses(df).collect())
    assert got == [("CC-BY-SA-4.0", 0, "Licensed under CC BY-SA 4.0"), ("MIT", 2, "Relaesed under\nthe MIT  License")]
    with pytest.raises(ValueError):
        license_scan.scan_licenses(df, {"x": "abc"})


def test_each_licence_line_gets_its_own_name(spark):
    lines = {k: f"{v}." for k, v in license_scan.NOTICES.items()}
    named = ["All-Rights-Reserved", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CC-BY-3.0", "CC0-1.0", "GPL-2.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "Apache-1.1", "MPL-1.1"]
    assert set(named) <= set(lines)
    keys = list(lines)
    df = spark.createDataFrame([(i, f"Some words.\nThis work is {lines[k]}\nMore words") for i, k in enumerate(keys)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.license, r.n_edits) for r in license_scan.scan_licenses(df).collect())
    assert got == [(i, k, 0) for i, k in enumerate(keys)]


def test_piece_coding(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_coding.MODEL)
    encoded = piece_coding.encode_pieces(clashing(docs)).collect()
    assert sorted((str(r.doc_id), r.piece_ids) for r in encoded) == sorted((str(i), None if t is None else sp.encode(t)) for i, t, *_ in rows())
    assert all(r.round_trip in (True, None) for r in encoded)
    m = piece_coding.model(piece_coding.MODEL)
    rng = random.Random(7)
    odd = ["", " ", "  a  b ", "▁x", "日本語 ☃\n\nx", "a" * 3000] + ["".join(rng.choice("ab c=-▁é\n日the ing") for _ in range(rng.randrange(1, 50))) for _ in range(1500)]
    for t in odd:
        assert m.encode(t).tolist() == sp.encode(t) and m.decode(sp.encode(t)) == sp.decode(sp.encode(t))
    # the memory of units and their cuts don't matter
    for t in odd[:200]:
        whole = (piece_coding._META + t.replace(" ", piece_coding._META)) if t else ""
        assert (m.unit(whole) if t else []) == sp.encode(t)
    back = piece_coding.decode_pieces(piece_coding.encode_pieces(docs)).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t) for i, t, *_ in rows())
    assert piece_coding.encode_pieces(empty(spark)).count() == 0


def test_lm_sizes_against_plain_compression(spark, docs):
    import zstandard

    chosen = spark.createDataFrame([(i,) for i in range(0, 30, 2)] + [(None,)], "doc_id bigint")
    counts = {"n": Counter(), "n_in": Counter()}
    for i, t, *_ in rows():
        for w in (t or "").split():
            counts["n"][w] += 1
            counts["n_in"][w] += i in range(0, 30, 2)
    contents = []
    for c in (counts["n_in"], counts["n"]):
        words, used = [], 0
        for w in sorted((w for w in c if c[w]), key=lambda w: (-c[w] * len(w.encode()), w)):
            if used + len(w.encode()) + 1 > 3000:
                break
            words.insert(0, w)
            used += len(w.encode()) + 1
        contents.append("".join(w + " " for w in words).encode())

    def size(content, text):
        raw, total = text.encode(), 0
        setting = zstandard.ZstdCompressionParameters.from_level(3, source_size=512, dict_size=len(content), write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
        while raw:
            part, raw = raw[:512], raw[512:]
            total += len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=setting).compress(part))
        return total

    want = Counter((i, size(contents[0], t or ""), size(contents[1], t or "")) for i, t, *_ in rows())
    got = lm_scoring.lm_scores(clashing(docs), chosen, 3000).collect()
    assert Counter((r.doc_id, r.in_domain_size, r.general_size) for r in got) == want
    assert all(r.score == (round((r.general_size - r.in_domain_size) / r.general_size, 6) if r.general_size else 0) for r in got)


def test_lm_scores_do_not_hang_on_length_or_on_long_words(spark):
    rng = random.Random(8)
    inside = [f"in{i:03d}word" for i in range(300)] + ["w" * 70 + str(i) for i in range(20)]
    data = [(i, " ".join(rng.choice(inside if i % 2 else [f"out{k:03d}word" for k in range(300)]) for _ in range(n))) for i, n in enumerate([500] * 40 + [50] * 20 + [50_000] * 2)]
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(spark.createDataFrame(data, "doc_id bigint, text string"), spark.createDataFrame([(i,) for i in range(1, 40, 2)], "doc_id bigint"), 6000).collect()}
    short, long = sum(got[i] for i in range(41, 60, 2)) / 10, got[61]
    assert abs(short - long) <= 0.1 * long and long > 0.1
    counts = lm_scoring.word_counts(spark.createDataFrame(data, "doc_id bigint, text string"), spark.createDataFrame([], "doc_id bigint"))
    assert b"w" * 70 in lm_scoring.dictionary(counts, "n", 6000)


def test_lm_scoring(spark, docs):
    rng = random.Random(2)
    inside, outside = ([f"{p}{i:03d}word" for i in range(400)] for p in ("in", "out"))
    data = [(i, " ".join(rng.choice(inside if i % 2 else outside) for _ in range(80)), "en", "s", 1) for i in range(200)]
    chosen = spark.createDataFrame([(i,) for i in range(1, 120, 2)] + [(None,), (1,)], "doc_id bigint")
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(clashing(spark.createDataFrame(data, DOC)), chosen, 2000).collect()}
    held = [i for i in got if i >= 120]
    wins = [got[a] > got[b] for a in held if a % 2 for b in held if not b % 2]
    assert sum(wins) >= 0.9 * len(wins)
    counts = {r.word: (r.n, r.n_in) for r in lm_scoring.word_counts(docs, spark.createDataFrame([(0,)], "doc_id bigint")).collect()}
    want = Counter(w for _, t, *_ in rows() for w in (t or "").split())
    assert {w: n for w, (n, _) in counts.items()} == want and sum(n for _, n in counts.values()) == len(rows()[0][1].split())
    same = lm_scoring.lm_scores(docs, chosen.limit(0)).collect()
    assert len(same) == len(rows()) and all(r.score == 0 for r in same)
    assert lm_scoring.lm_scores(empty(spark), chosen).count() == 0


@pytest.mark.parametrize("per_fragment,most_docs", [(1_000_000, 20_000), (40, 7)])
def test_corpus_scores_against_brute_force(spark, docs, per_fragment, most_docs):
    data = [(r.doc_id, r.text) for r in docs.collect()]
    inside = {*range(0, 30, 2), 101, 200, 201}
    count = {"n": Counter(), "n_in": Counter()}
    rows_of, in_of = defaultdict(set), defaultdict(set)
    cut = {}
    for k, (i, t) in enumerate(data):
        for w in (t or "").split():
            count["n"][w] += 1
            count["n_in"][w] += i in inside
        cut[k] = lm_scoring.cut_pieces((t or "").encode())
        assert b"".join(cut[k]) == (t or "").encode()
        for p in cut[k]:
            rows_of[p].add(k)
            if i in inside:
                in_of[p].add(k)

    def words(c):
        out, used = [], 0
        for w in sorted((w for w in c if c[w]), key=lambda w: (-c[w] * len(w.encode()), w)):
            if used + len(w.encode()) + 1 > 3000:
                break
            out.insert(0, w)
            used += len(w.encode()) + 1
        return lm_scoring.sizer("".join(w + " " for w in out).encode(), 1 << 30)

    in_words, all_words = words(count["n_in"]), words(count["n"])
    own = lambda p: lm_scoring.sizer(p, len(p))(p) if len(p) >= 8 else 99
    want = Counter()
    for k, (i, _) in enumerate(data):
        x = sum(min(in_words(p), own(p)) if in_of[p] - {k} else in_words(p) for p in cut[k])
        y = sum(min(all_words(p), own(p)) if len(rows_of[p]) > 1 else all_words(p) for p in cut[k])
        want[(i, x, y, round((y - x) / y, 6) if y else 0.0)] += 1
    chosen = spark.createDataFrame([(i,) for i in inside] + [(None,), (0,)], "doc_id bigint")
    got = lm_scoring.corpus_scores(clashing(docs), chosen, 3000, per_fragment=per_fragment, most_docs=most_docs).collect()
    assert Counter(tuple(r) for r in got) == want
    same = lm_scoring.corpus_scores(docs, chosen.limit(0), 3000).collect()
    assert len(same) == len(data) and all(r.score == 0 for r in same)
    assert lm_scoring.corpus_scores(empty(spark), chosen).count() == 0
    blank = lm_scoring.corpus_scores(spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id bigint, text string"), chosen).collect()
    assert Counter(tuple(r) for r in blank) == {(1, 0, 0, 0.0): 2, (None, 0, 0, 0.0): 1}


def test_corpus_scores_notice_a_second_copy(spark):
    rng = random.Random(5)
    data = [(i, text(rng, 300)) for i in range(60)]
    data += [(100 + i, data[i][1]) for i in range(10)] + [(200 + i, "in between " + " ".join(data[20 + i][1].split()[50:250]) + " something else") for i in range(5)]
    got = {r.doc_id: r.general_size / len(t) for r, t in ((r, dict(data)[r.doc_id]) for r in lm_scoring.corpus_scores(spark.createDataFrame(data, "doc_id bigint, text string"), spark.createDataFrame([], "doc_id bigint"), 2000).collect())}
    once = min(v for i, v in got.items() if 30 <= i < 60)
    assert max(v for i, v in got.items() if i < 10 or 100 <= i < 110) < 0.4 * once
    assert max(v for i, v in got.items() if i >= 200) < once
