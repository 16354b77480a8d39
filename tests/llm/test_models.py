"""Packing, sampled pieces, archives and the quality model."""

import base64
import collections
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from conftest import SF, rows
from pyspark.sql import functions as F

from bizpulse.llm import packing, quality_gam, queries, sampled_pieces, warc_zst

TOKENIZER, MODEL = queries.tokenizer_file("word_bpe_49k.json"), queries.tokenizer_file("piece_bpe_32k.model")
ODD = [
    "", " ", "\n", "a", "Hi, there. It's I'd 12ab", "É.. «à».", "J̌ ab", "<|endoftext|> <|ENDOFTEXT|>", "a\x1fb\x85c\xa0d", "😀 汉字 ▁x ▁", "  two  spaces ",
    "x" * 5000, "\t\r\n", "ſ İ ŉ ß", "a.b,c ...", "A.B. , C", "‍﻿", "nón",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(2)
    data = [(i, t) for i, t in enumerate(ODD)] + [(50, None)]
    data += [(100 + i, " ".join(rng.choice(["the", "Tion,", "eau.", "x9", "!!"]) for _ in range(rng.choice([3, 30, 300, 2000])))) for i in range(120)]
    data += [(100, data[-1][1]), (None, "null id"), (7, ODD[7])]  # an id with two texts, a null id, a repeated row
    return data, spark.createDataFrame(data, "doc_id long, text string")


def ids_of(text):
    return np.array(packing._tokenizer(TOKENIZER).encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check_packed(pieces, docs, window):
    """Every id in exactly one piece, sequences gapless and within the window; the number of sequences that are short by more
    than the slack."""
    wanted = collections.Counter((i, ids_of(t).tobytes()) for i, t in docs)
    parts = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        parts[p.doc_id].append(p)
    for i, own in parts.items():
        whole = sorted(b for (j, b), n in wanted.items() if j == i for _ in range(n))
        total = sum(p.length for p in own)
        assert total == sum(len(b) // 4 for b in whole)
        if len(whole) == 1:
            own.sort(key=lambda p: p.start)
            assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
            assert b"".join(p.ids for p in own) == whole[0] and {p.doc_tokens for p in own} == {len(whole[0]) // 4}
        else:
            for p in own:
                assert any(len(b) == 4 * p.doc_tokens and b[4 * p.start : 4 * (p.start + p.length)] == p.ids for b in whole)
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return sum(sum(n for _, n in own) < window - int(window * packing.SLACK) for own in sequences.values())


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(spark, texts, window):
    data, df = texts
    pieces = packing.pack(df, TOKENIZER, window=window).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in data}
    assert check_packed(pieces, data, window) <= 1


def test_packing_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    pieces = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), TOKENIZER).collect()
    assert check_packed(pieces, docs, 2048) <= 1
    cuts = len(pieces) - sum(-(-len(ids_of(t)) // 2048) for _, t in docs)
    assert cuts <= 0.1 * len(docs)  # combinations and best fit leave most remainders whole
    got = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op7_packing(spark, SF).collect()}
    assert got == {(p.doc_id, p.start): zlib.crc32(p.ids) for p in pieces}


def test_packing_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER).count() == 0


def test_word_ids_are_the_tokenizers(texts):
    coder = packing.WordIds(TOKENIZER)
    for _, text in texts[0]:
        assert coder.encode([text or ""])[0] == ids_of(text)[:-1].tobytes()
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aBé.,!'s12 \n-|<>ßÀtd́") for _ in range(30))
        assert coder.encode([text])[0] == ids_of(text)[:-1].tobytes(), text


def test_least_squares_fills_windows():
    rng = np.random.default_rng(0)
    counts = np.zeros(64, np.int64)
    for a in rng.integers(1, 63, 4000):
        counts[a] += 1
    columns = packing.combinations(counts, 64)
    x = packing.nnls(columns, counts.astype(float))
    made = np.zeros(64)
    for c, times in zip(columns, x):
        for a in c:
            made[a] += times
    assert x.min() >= 0 and np.linalg.norm(made - counts) < 0.5 * np.linalg.norm(counts)
    used, slots, left = packing.allot(counts, 64)
    assert all(sum(c) == 64 for c, _ in used)
    placed = np.zeros(64, np.int64)
    for c, times in used:
        for a in c:
            placed[a] += times
    assert (placed + left == counts).all() and left.min() >= 0
    for a, own in slots.items():
        assert own[0][0] == 0 and all(x[1] == y[0] for x, y in zip(own, own[1:])) and own[-1][1] <= counts[a]


@pytest.mark.parametrize("n", [10_000, 300_000])
def test_most_remainders_are_placed_whole(n):
    """Lengths as in the given tables: many short ones and a flat rest."""
    rng = np.random.default_rng(n)
    lengths = np.concatenate([rng.integers(1, 2048, n // 2), rng.geometric(1 / 300, n // 2) % 2047 + 1])
    counts = np.bincount(lengths, minlength=2048)
    used, _, left = packing.allot(counts, 2048)
    windows = sum(times for _, times in used) + -(-int((left * np.arange(2048)).sum()) // 2048)
    assert left.sum() <= 0.05 * n and windows <= 1.01 * -(-lengths.sum() // 2048)


def test_lengths_that_fit_nowhere_are_laid_end_to_end():
    counts = np.zeros(2048, np.int64)
    counts[1500], counts[1400] = 300, 200
    used, _, left = packing.allot(counts, 2048)
    assert used == [] and (left == counts).all()


def test_packing_with_extra_columns(spark):
    data = [(1, "a b c", 5, 6), (1, "a b c", 5, 6), (2, None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, length int, sequence_id int")
    got = packing.pack(df, TOKENIZER).collect()
    assert check_packed(got, [(r[0], r[1]) for r in data], 2048) <= 1 and len(got) == 3


def test_remainders_of_the_given_documents_at_a_larger_scale(spark):
    sf = "/root/testdata/sf0.1"
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), TOKENIZER).drop("ids").toPandas()
    docs, tails = pieces.doc_id.nunique(), (pieces.groupby("doc_id").doc_tokens.first() % 2048 > 0).sum()
    extra = len(pieces) - int((-(-pieces.groupby("doc_id").doc_tokens.first() // 2048)).sum())
    ideal = -(-int(pieces.length.sum()) // 2048)
    assert docs == 10_000 and extra <= 0.05 * tails
    assert pieces.sequence_id.nunique() <= 1.01 * ideal


def test_pieces_are_lossless_and_reproducible(spark, texts):
    _, df = texts
    coded = sampled_pieces.encode_texts(df, MODEL)
    back = sampled_pieces.decode_pieces(coded, MODEL)
    assert back.filter("decoded <> coalesce(text, '')").count() == 0 and back.count() == df.count()
    again = {(r.doc_id, r.text): tuple(r.pieces) for r in sampled_pieces.encode_texts(df.repartition(7), MODEL).collect()}
    assert again == {(r.doc_id, r.text): tuple(r.pieces) for r in coded.collect()}
    other = {(r.doc_id, r.text): tuple(r.pieces) for r in sampled_pieces.encode_texts(df, MODEL, seed=1).collect()}
    assert other != again
    assert sampled_pieces.encode_texts(df.filter("false"), MODEL).count() == 0
    assert sampled_pieces.encode_texts(df.withColumn("pieces", F.lit(1)), MODEL).columns == ["doc_id", "text", "pieces"]


def test_samples_follow_the_lattice():
    """Frequencies of whole segmentations against their weights, found by listing all of them."""
    vocabulary = sampled_pieces.pieces(MODEL)
    lattices = sampled_pieces.Lattices(vocabulary, 0.5)
    text = "there"

    def paths(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in lattices.weights:
                for tail, weight in paths(rest[n:]):
                    yield (vocabulary.ids[rest[:n]], *tail), weight * lattices.weights[rest[:n]]

    weights = dict(paths(" " + text))
    total, n = sum(weights.values()), 40_000
    counts = collections.Counter(tuple(x.tolist()) for x in sampled_pieces.sample([text] * n, np.arange(n), lattices, 3))
    assert set(counts) <= set(weights) and len(counts) > 5
    for path, weight in weights.items():
        p = weight / total
        assert abs(counts[path] - n * p) < 6 * (n * p * (1 - p)) ** 0.5 + 1
    long = "thereisnospaceinthis" * 3000  # forward sums would vanish without rescaling
    assert sampled_pieces.decode(sampled_pieces.sample([long], np.array([1]), lattices, 0)[0], vocabulary) == long


def test_long_chunks_take_little_memory():
    import tracemalloc

    vocabulary = sampled_pieces.pieces(MODEL)
    lattices = sampled_pieces.Lattices(vocabulary, 1.0)
    chunk = "".join(random.Random(4).choice("thereisnospace汉字😀") for _ in range(60_000))
    sampled_pieces._sample_long(chunk[:500], np.uint64(5), 0, lattices)
    tracemalloc.start()
    found = sampled_pieces._sample_long(chunk, np.uint64(5), 0, lattices)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 * len(chunk)  # 2 million characters stay below 500 MB
    assert found[0][0] == len(chunk)
    # A piece at a time and all together draw from the same distribution with the same numbers.
    short = "thereisnospaceinthis" * 9
    keys = np.arange(200)
    row = sampled_pieces.mix64(keys.view(np.uint64) ^ sampled_pieces.mix64(np.array([3], np.uint64)))
    both = sampled_pieces.sample([short] * 200, keys, lattices, 3)
    alone = [sampled_pieces._sample_long(" " + short, r, 0, lattices)[::-1] for r in row]
    same = sum([label for _, label in own] == ids.tolist() for own, ids in zip(alone, both))
    assert same >= 198  # single precision decides otherwise at most where a number lies on an edge


PAGES = "page_id long, url string, html string, extra int"


def test_archives(spark):
    data = [(1, "http://a/ b", "same", 1), (5, None, "same", 2), (3, "u", "same", 3), (2, "u", None, 4), (4, "u", "", 5), (6, "ü", "é" * 300_000, 6), (7, "u", "x", 7), (7, "u", "x", 7), (None, "u", "same", 8), (None, "v", "alone", 9)]
    df = spark.createDataFrame(data, PAGES)
    got = warc_zst.archive_round_trip(df).collect()
    own = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert own == sorted([
        ("1", "revisit", "5", 4), ("5", "response", None, 4), ("3", "revisit", "5", 4), ("2", "revisit", "4", 0), ("4", "response", None, 0), ("6", "response", None, 600_000),
        ("7", "response", None, 1), ("7", "response", None, 1), ("None", "revisit", "5", 4), ("None", "response", None, 5),
    ])
    digests = {r.payload_bytes: r.payload_digest for r in got}
    assert digests[600_000] == base64.b32encode(hashlib.sha1(("é" * 300_000).encode()).digest()).decode()
    assert [bytes(r.payload) for r in got if r.record_id == "6"] == [("é" * 300_000).encode()]
    all_responses = warc_zst.archive_round_trip(df, least_bytes=5).filter("record_type = 'revisit'")
    assert all_responses.count() == 0
    assert warc_zst.archive_round_trip(df.filter("false")).count() == 0


def test_a_payload_of_many_pages_is_spread_over_the_archives(spark):
    pages = spark.range(2000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 4 > 0, F.lit("same page " * 50)).otherwise(F.concat(F.lit("page "), "id")).alias("html")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", before):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            records = warc_zst.archive_round_trip(pages.repartition(8)).collect()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        each = collections.Counter(r.archive for r in records)
        assert len(records) == 2000 and max(each.values()) < 2 * 2000 / len(each)
        assert {r.refers_to for r in records if r.record_type == "revisit"} == {"1999"}
        assert sum(r.record_type == "revisit" for r in records) == 1499


def test_payloads_are_never_joined_by_their_digest(spark):
    rows_ = spark.createDataFrame([(1, b"x"), (2, b"x"), (None, b"x"), (3, b"y"), (3, b"y"), (None, b"z")], "page_id long, sha binary")
    found = warc_zst.originals(rows_)
    assert "payload" not in found._jdf.queryExecution().toString()
    assert rows(found.select("page_id", "original")) == [(None, 2), (1, 2)]


def test_warc_with_very_long_urls(spark):
    urls = ["data:text/html," + "x" * 100_000, "http://h/" + " \x01" * 50_000, "http://h/"]
    df = spark.createDataFrame([(i, u, f"page {i // 2}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.record_id: (r.record_type, r.target_uri) for r in warc_zst.archive_round_trip(df).collect()}
    assert got == {"0": ("revisit", urls[0]), "1": ("response", urls[1].replace(" ", "%20").replace("\x01", "%01")), "2": ("response", urls[2])}


def test_archives_of_the_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    records = warc_zst.archive_round_trip(spark.read.parquet(f"{SF}/pages.parquet"))
    assert {int(r.record_id): (r.payload or b"").decode() for r in records.collect()} == pages


def archive(contents, dictionary=b""):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=shared)
    return (warc_zst.dictionary_frame(dictionary) if dictionary else b"") + b"".join(packer.compress(c) for c in contents)


def test_frames_and_dictionary(monkeypatch):
    rng = random.Random(1)
    contents = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(n)).encode() for n in (1, 50, 900)]
    dictionary = zstandard.train_dictionary(2048, [b" ".join(rng.choice([b"alpha", b"beta", b"gamma", b"delta"]) for _ in range(60)) for _ in range(300)]).as_bytes()
    for size in (7, 1 << 20):
        monkeypatch.setattr(warc_zst, "READ_BYTES", size)
        for d in (b"", dictionary):
            data = archive(contents, d)
            if size > 7 or not d:
                assert list(warc_zst.frames(io.BytesIO(data))) == contents
            with pytest.raises(warc_zst.BadArchive):
                list(warc_zst.frames(io.BytesIO(data[:-3])))
    plain = warc_zst.struct.pack("<II", warc_zst.DICTIONARY_MAGIC, len(dictionary)) + dictionary + archive(contents, dictionary)[len(warc_zst.dictionary_frame(dictionary)) :]
    assert list(warc_zst.frames(io.BytesIO(plain))) == contents


def test_broken_records_are_refused():
    good = warc_zst.record(1, "u", b"body", base64.b32encode(hashlib.sha1(b"body").digest()).decode())
    assert warc_zst.parse(good)["payload"] == b"body"
    for old, new in ((b"WARC/1.1", b"WURC/1.1"), (b"Content-Length: 4", b"Content-Length: 5"), (b"body", b"bady"), (b"WARC-Record-ID", b"X"), (b"\r\n\r\n", b"\n\n"), (b"WARC-Date:", b"WARC-Date")):
        with pytest.raises(warc_zst.BadArchive):
            warc_zst.parse(good.replace(old, new))
    with pytest.raises(warc_zst.BadArchive):
        warc_zst.parse(good + b"x")


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    both = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert got.count() == 1000 and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert (both.predicted == both.quality).mean() > 0.93
    assert both[both.quality == 1].predicted.mean() > 0.97
    assert {zlib.crc32(str(i).encode()) % 5 for i in both.doc_id} == {0}


def brute_features(text):
    """The features of a text by their names, in plain Python."""
    import math

    raw = (text or "").encode()
    own = [w for w in raw.split() if w]
    if not own:
        return [0.0] * len(quality_gam.FEATURES)
    kinds, lines, share = collections.Counter(own), raw.split(b"\n"), lambda keep: sum(keep(b) for b in raw) / len(raw)
    return [
        math.log1p(len(own)), sum(map(len, own)) / len(own), sum(len(w) > 12 for w in kinds) / len(kinds), len(kinds) / len(own), max(kinds.values()) / len(own),
        sum(a == b for a, b in zip(own, own[1:])) / len(own), share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in b"#*$%&<>@^~=_\\/{}[]"),
        raw.count(b"!") / len(own), raw.count(b"|") / len(own), raw.count(b".") / len(own), len(lines) / len(own), 1 - len(set(lines)) / len(lines), share(lambda b: b > 127),
        math.log1p(max(map(len, own))),
    ]


def test_quality_scores_are_sums_of_table_entries(spark):
    """The query's scores on the given documents against the model evaluated an entry at a time."""
    import bisect
    import math

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(~queries.held_out())
    model = quality_gam.train(docs, labels)
    got = {r.doc_id: (r.score, r.predicted, r.held_out) for r in queries.op6_quality(spark, SF).collect()}
    assert len(got) == docs.count()
    for row in docs.collect():
        x = brute_features(row.text)
        bins = [bisect.bisect_right(edges.tolist(), value) for edges, value in zip(model.edges, x)]
        total = model.start + sum(table[b] for table, b in zip(model.tables, bins))
        total += sum(grid[model.coarse[i][bins[i]]][model.coarse[j][bins[j]]] for (i, j), grid in zip(model.pairs, model.grids))
        score, predicted, held = got[row.doc_id]
        assert abs(score - 1 / (1 + math.exp(-total))) < 1e-9
        assert predicted == (score >= 0.3) and held == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def test_quality_model_learns_pairs():
    """Labels that depend on two features together and on neither alone."""
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality_gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_quality_odd_cases(spark):
    docs = spark.createDataFrame([(1, "a b c", 0.5), (2, None, 0.1), (3, "", 0.2), (3, "", 0.2), (4, "x" * 400_000, 0.3)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    model = quality_gam.train(docs, labels)
    got = quality_gam.classify(docs, model)
    assert got.count() == 5 and got.columns == ["doc_id", "text", "score", "predicted"]
    none = quality_gam.train(docs, labels.filter("false"))
    assert quality_gam.classify(docs, none).filter("score = 0.5").count() == 5
    assert quality_gam.classify(docs.filter("false"), none).count() == 0
