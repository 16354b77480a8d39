"""Line runs, n-gram join, cap filters and components against brute force."""

import random

import brute
import numpy as np
import pytest
from conftest import SF, rows

from bizpulse.llm import cap_filters, common, line_dedup, ngram_join, queries

DOC = "doc_id long, text string"


def family(seed=1, bases=12, copies=9, length=60):
    """Texts with exact copies, near copies at all similarities, shared passages, and odd ones."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randint(0, 400))
    passage = [word() for _ in range(30)]
    out = [None, "", " \n ", "one", "one", "one two", "one two three four five", "one two three four five"]
    for _ in range(bases):
        base = [word() for _ in range(rng.randint(8, length))]
        if rng.random() < 0.4:
            base[3:3] = passage
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
    return dict(enumerate(out))


def test_ngram_join(spark):
    docs = family()
    got = ngram_join.similar_documents(spark.createDataFrame(list(docs.items()), DOC))
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == brute.near(docs)


def test_ngram_join_over_blocks(spark, monkeypatch):
    """Buckets and components larger than a block are compared block by block and lose nothing."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    docs = family(seed=2, bases=4, copies=24)
    got = ngram_join.similar_documents(spark.createDataFrame(list(docs.items()), DOC))
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == brute.near(docs)


def test_ngram_join_repeated_rows_null_ids_and_empty(spark):
    long = " ".join(f"w{i % 5000}" for i in range(120_000))
    data = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (3, long), (4, long + " x")]
    got = ngram_join.similar_documents(spark.createDataFrame(data, DOC))
    assert rows(got.select("doc_id", "class_id", "n_links")) == [(1, 1, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1)]
    assert ngram_join.similar_documents(spark.createDataFrame([], DOC)).count() == 0


def test_ngram_join_with_extra_and_clashing_columns(spark):
    names = "doc_id long, text string, class_id int, copy_id int, n_links int, id int, values int, component int"
    data = [(i, t, 1, 2, 3, 4, 5, 6) for i, t in enumerate(["a b c d e f", "a b c d e f", "x y", None])]
    got = ngram_join.similar_documents(spark.createDataFrame(data, names))
    assert rows(got) == [(0, 0, 0, 1), (1, 0, 0, 1), (2, 2, 2, 0), (3, 3, 3, 0)]


def test_pruning_table_is_the_posterior_tail():
    """Against numerical integration of the posterior density s^m (1 - s)^(n - m)."""
    s = (np.arange(20_000) + 0.5) / 20_000
    for look, least in enumerate(ngram_join.least_matches(0.8, 1e-6)):
        n = (look + 1) * ngram_join.STEP
        tails = []
        for m in (least - 1, least):
            density = np.exp(m * np.log(s) + (n - m) * np.log1p(-s)) if m >= 0 else np.zeros(1)
            tails.append(density[s >= 0.8].sum() / density.sum() if m >= 0 else 0.0)
        assert tails[0] < 1e-6 <= tails[1]


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    same = [np.mean(ngram_join.minhashes(a[:2000]) == ngram_join.minhashes(a[k : 2000 + k])) for k in (0, 250, 1000)]
    assert same[0] == 1 and abs(same[1] - 1750 / 2250) < 0.13 and abs(same[2] - 1000 / 3000) < 0.15


def test_line_dedup(spark):
    rng = random.Random(4)
    pool = [f"  Line Number {i} É " for i in range(40)] + ["short", "", "\t", "ÄÖÜÄÖÜÄÖÜ", "ÄÖÜÄÖÜÄÖÜÄ", "line number 3 É"]
    docs = {i: "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8))) for i in range(200)}
    docs |= {200: None, 201: "\n", 202: "x" * 200_000, 203: "X" * 200_000 + "\r"}
    df = spark.createDataFrame(list(docs.items()), DOC)
    for batches in (1, 4):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(df, batches=batches).collect()}
        assert got == brute.line_dedup(docs)


def test_line_runs_compact_and_go_on(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    docs = {i: f"line of batch {i // 3} here\ncommon line for all\nown line {i} of this" for i in range(15)}
    got = {}
    for low in range(0, 15, 3):
        part = {i: docs[i] for i in range(low, low + 3)}
        kept = line_dedup.dedup_lines(spark.createDataFrame(list(part.items()), DOC), batches=1, runs=runs)
        got |= {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in kept.collect()}
    assert got == brute.line_dedup(docs)
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # 5 runs = 101 in twos
    runs.drop()


def test_line_dedup_repeated_rows_null_ids_clashing_names(spark):
    data = [(1, "a repeated line", 7, "x"), (1, "a repeated line", 8, "y"), (2, "A Repeated Line \nb", 9, "z"), (None, "the null one wins", 1, "q"), (5, "the null one wins", 2, "r")]
    df = spark.createDataFrame(data, "doc_id long, text string, drop_keys int, n_lines string")
    got = line_dedup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "drop_keys", "n_lines", "n_dropped"]
    assert sorted((r.drop_keys, r.text) for r in got.collect()) == [(1, "the null one wins"), (2, ""), (7, "a repeated line"), (8, "a repeated line"), (9, "b")]
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOC)).count() == 0


def vectors(seed=3, dim=64, families=15, size=8):
    rng = np.random.default_rng(seed)
    out = []
    for f in range(families):
        base = rng.standard_normal(dim)
        for k in range(size):
            out.append((base + rng.standard_normal(dim) * rng.choice([0, 0.1, 0.25, 0.38])).tolist())
    out += rng.standard_normal((60, dim)).tolist()
    labels = rng.integers(0, 3, len(out)).tolist()
    return [(i, v, l) for i, (v, l) in enumerate(zip(out, labels))]


def test_cap_filters(spark, monkeypatch):
    data = vectors()
    bad = [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [None] + [1.0] * 63, data[0][1], [3 * x for x in data[0][1]], [1e300 * x for x in data[0][1]], data[1][1]]
    data += [(1000 + i, v, data[0][2]) for i, v in enumerate(bad)]
    data[-1] = (*data[-1][:2], None)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    wanted = brute.near_vectors([(i, v if i != 1008 else data[0][1], l) for i, v, l in data])
    for block in (1024, 4):
        monkeypatch.setattr(cap_filters, "BLOCK_ROWS", block)
        got = {r.vec_id: (r.component_id, r.n_links) for r in cap_filters.near_vectors(df).collect()}
        assert got == wanted


def test_cap_filters_join_each_dimension(spark, monkeypatch):
    """Vectors of two models, mixed, and dimensions of one and two vectors; labels are shared by all."""
    data = [(3 * i, v, l) for i, v, l in vectors()] + [(3 * i + 1, v, l) for i, v, l in vectors(seed=4, dim=48, families=10)]
    data += [(3 * i + 2, v, 0) for i, v in enumerate([[1.0], [1.0, 2.0], [1.0, 2.1], [2.0, -1.0], [1.0, 2.0, 0.0], [2.0, 4.0]])]
    wanted = {}
    for dim in {len(v) for _, v, _ in data}:
        wanted |= brute.near_vectors([row for row in data if len(row[1]) == dim])
    assert sum(n for i, (_, n) in wanted.items() if i % 3 == 1) > 50 and wanted[5][1] == wanted[8][1] == 2
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)
    for block in (1024, 4):
        monkeypatch.setattr(cap_filters, "BLOCK_ROWS", block)
        assert {r.vec_id: (r.component_id, r.n_links) for r in cap_filters.near_vectors(df).collect()} == wanted


def test_caps_reach_pairs_at_the_threshold():
    """Recall at a cosine of exactly 0.93, the hardest pairs, with the production parameters."""
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for words in (12, 32, 48, 64):
        met = np.zeros(600, bool)
        for code in cap_filters.cap_codes(64, words):
            met |= [bool(set(x.tolist()) & set(y.tolist())) for x, y in zip(code.decode(a), code.decode(b))]
        assert met.mean() >= 0.998


def test_codes_grow_with_the_vectors():
    for count in (10, 10**5, 10**7, 10**9):
        words = cap_filters.code_words(count)
        assert words**cap_filters.BLOCKS >= 2 * count * cap_filters.CAPS and (words - 1) ** cap_filters.BLOCKS < max(2 * count * cap_filters.CAPS, 12**4)


def test_caps_of_many_dimensions_are_apart_and_found_in_slices():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    vectors = [v / np.linalg.norm(v) for v in (rng.standard_normal(rng.choice([3, 5, 64])) for _ in range(80))]
    codes = {dim: cap_filters.cap_codes(dim, words) for dim, words in ((3, 12), (5, 14), (64, 13))}
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array([0] * 80), pa.array([v.tolist() for v in vectors])], ["rep", "label", "unit"])
    found = []
    for sums in (1, 400, 1 << 22):
        out = [(r["rep"], r["cap"]) for b in cap_filters._decoded(codes, sums)(iter([batch])) for r in b.to_pylist()]
        found.append(sorted(out))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(set(found[0]))
    dims = {}
    for rep, cap in found[0]:
        assert dims.setdefault(cap, len(vectors[rep])) == len(vectors[rep])


def test_cosines_at_the_threshold_are_decided_alike():
    """Pairs whose cosine is the threshold to the last bits: the same verdict from rows, blocks and either order."""
    rng = np.random.default_rng(6)
    units = rng.standard_normal((40, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for threshold in (float(units[0] @ units[1]), float((units @ units.T)[0, 1]), float(units[3] @ units[2])):
        rows_ = np.array([cap_filters.alike(units, i, np.arange(40), threshold) for i in range(40)])
        assert (rows_ == rows_.T).all()
        some = np.array([[cap_filters.alike(units[[i, k]], 0, np.array([1]), threshold)[0] for k in range(40)] for i in range(40)])
        assert (some == rows_).all()


def test_cap_decoding_finds_every_direction():
    code = cap_filters.CapCode(10, 5, caps=20, least=9)
    vectors = np.random.default_rng(2).standard_normal((20, 10))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for v, got in zip(vectors, code.decode(vectors)):
        parts = np.einsum("bwd,bd->bw", code.books, (code.turn @ v).reshape(4, 3))
        whole = (parts[0][:, None, None, None] + parts[1][:, None, None] + parts[2][:, None] + parts[3]).ravel()
        assert sorted(got.tolist()) == np.flatnonzero(whole > min(code.height, np.sort(whole)[-9] - 1e-12)).tolist()


def test_cap_filters_empty_and_repeated(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert cap_filters.near_vectors(spark.createDataFrame([], schema)).count() == 0
    one = [1.0] * 8
    data = [(1, one, 0), (1, one, 0), (2, one, 0), (None, one, 0), (3, None, 0)]
    assert rows(cap_filters.near_vectors(spark.createDataFrame(data, schema))) == [(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, rng.randint(6, 40)) for _ in range(30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = dict(rows(common.components(spark.createDataFrame(edges, "a long, b long"))))
    plain = {}
    for a, b in (e for e in edges if None not in e and e[0] != e[1]):
        merged = plain.get(a, {a}) | plain.get(b, {b})
        for x in merged:
            plain[x] = merged
    assert got == {x: min(own) for x, own in plain.items()}


def test_queries_on_the_given_tables(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op2_ngram_join(spark, SF).collect()}
    assert got == brute.near(docs)


def test_hash_sample_is_bounded_and_repeats(spark):
    df = spark.range(5000).withColumnRenamed("id", "i")
    for most in (0, 10, 800, 9000):
        one, two = ([r.i for r in common.hash_sample(d, ["i"], most).collect()] for d in (df, df.repartition(9)))
        assert one == two and len(set(one)) == len(one) == min(most, 5000)
    assert common.hash_sample(df.limit(0), ["i"], 5).count() == 0
