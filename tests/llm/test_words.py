"""Spelling variants, phrases and formatted conversations against brute force, on odd input and on the given tables."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from bizpulse.llm import chat_format, collocations, queries, spelling

DOC = "doc_id long, text string, lang string, word int, n int, phrase int"


# -- spelling


def near(a, b):
    """Whether one code point inserted, deleted or replaced makes the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_vocabulary(docs, least_length=6, least_count=5, every=199):
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def brute_variants(words, times=5):
    forms, out = {}, {}
    by_near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    for w, others in by_near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= times * words[w]:
            forms[w] = best
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (forms.get(w), root, words[w], len(by_near[w]), words[forms[w]] if w in forms else None)
    return out


def variants_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def family(seed, alphabet="abÿé", length=8, size=400):
    """Words with many near ones: repeated letters, runs, every length around `length`."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(length - 2, length + 2))) for _ in range(size)}
    words |= {"a" * n for n in range(6, 14)} | {"ab" * n for n in range(3, 7)} | {"ab" * n + "a" for n in range(3, 7)}
    for w in list(words)[:60]:
        at = rng.randrange(len(w))
        words |= {w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "z" + w[at + 1 :]}
    return {w: rng.choice([1, 2, 5, 5, 9, 30, 200, 5000]) for w in words if len(w) >= 6}


@pytest.mark.parametrize("most, seed", [(2048, 1), (40, 2), (1, 3)])
def test_near_words(spark, most, seed):
    """Whole buckets, buckets dealt anew, and buckets down to windows of one position give the same."""
    words = family(seed)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variants_of(spelling.variants(df, most=most)) == brute_variants(words)


def test_near_words_of_few_letters_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(spelling, "QUERIES", 7)
    monkeypatch.setattr(spelling, "CELLS", 300)
    words = {"".join(w): 1 + i % 60 for i, w in enumerate(itertools.product("ab", repeat=7))} | {"".join(w): 3 for w in itertools.product("ab", repeat=6)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variants_of(spelling.variants(df)) == brute_variants(words)


def test_edit_rows_are_reused_exactly():
    """Every pair of one bucket over all positions, against the plain definition."""
    for m, letters in ((6, "ab"), (9, "abc")):
        rng = random.Random(m)
        words = sorted({"".join(rng.choice(letters) for _ in range(n)) for n in (m - 1, m) for _ in range(60)})
        points = spelling._points(words, m)
        full = np.arange(len(words))
        firsts = full == 0
        a, b = spelling.near_pairs(points, np.array(list(map(len, words))), firsts, full * 0, full * 0 + m, slice(None))
        wanted = {(i, j) for i in full.tolist() for j in full.tolist() if near(words[i], words[j]) and max(len(words[i]), len(words[j])) == m}
        assert len(a) == len(wanted) and set(zip(a.tolist(), b.tolist())) == wanted


def test_chains_of_forms_end_at_their_root(spark):
    words = {"aaaaaa"[: 6 - k] + "bbbbbb"[:k] + "cccccc": 5**k for k in range(7)}
    got = variants_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {v[1] for v in got.values()} == {"bbbbbbcccccc"} and got == brute_variants(words)


def test_vocabulary(spark):
    rng = random.Random(4)
    pool = ["Colour", "COLOR", "naïvely", "NAÏVELY", "Äquator", "äquator", "straße", "x×÷yzabc", "œuvres", "word1word", "l’élève", "\U0001f600smile", "ĀĀĀĀĀĀ"]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(400))) for i in range(60)] + [(None, "nullid " * 9), (3, None), (4, ""), (5, "Colour " * 3), (5, "Colour " * 3)]
    docs.append((6, "longer" * 20_000 + " " + "longer" * 20_000))
    df = spark.createDataFrame([(i, t, "en", 1, 2, 3) for i, t in docs], DOC)
    for every in (199, 3):
        got = {r.word: r.n for r in spelling.vocabulary(df, every=every).collect()}
        assert got == brute_vocabulary(docs, every=every)
    assert spelling.variants(spelling.vocabulary(df.filter("false"))).count() == 0


def test_very_long_words(spark):
    words = {"ab" * 5000: 100, "ab" * 5000 + "a": 5, "ab" * 2500 + "c" + "ab" * 2500: 7, "b" + "ab" * 4999 + "a": 1, "ba" * 5000: 1}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants_of(spelling.variants(df))
    assert got == brute_variants(words)


# -- phrases


def pieces_of(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER))]


def brute_phrases(docs, least, depth=5, most=None):
    """docs: (text, lang)."""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, depth + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        inside = any(
            lang == other and len(q) > len(p) and b == a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in found.items()
        )
        if not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, own in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:most], 1)
    )


def story(seed, docs=60, words=60):
    rng = random.Random(seed)
    pool = ["the", "The", "of", "é", "École", "a", "b", "x\x1fy", "汉字", "😀", "a-b", "(c)"]
    passage = "once upon a time there was"
    out = []
    for _ in range(docs):
        own = [rng.choice(pool) if rng.random() < 0.9 else passage for _ in range(rng.randint(0, words))]
        out.append((rng.choice([" ", "\t ", "  "]).join(w + rng.choice(["", "", "", ".", ",", "\n", "\x0b", "?!"]) for w in own), rng.choice(["en", "en", "fr", None, ""])))
    return out + [(None, "en"), ("", "xx"), (" .\t.", None), ("the of " * 3000, "en"), ("tail", "fr")]


def phrase_rows(df):
    return sorted(tuple(r) for r in df.collect())


def as_docs(spark, docs):
    return spark.createDataFrame([(i, t, lang, 1, 2, 3) for i, (t, lang) in enumerate(docs)], DOC)


@pytest.mark.parametrize("least, share, chunk, seed", [(20, 4, 1 << 20, 1), (5, 200, 1 << 20, 2), (3, 10**6, 64, 3), (2, 50, 500, 4)])
def test_phrases(spark, monkeypatch, least, share, chunk, seed):
    """Groups of whole words and groups of prefixes of two to four words, in chunks of any size."""
    monkeypatch.setattr(collocations, "SHARE", share)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    docs = story(seed)
    got = phrase_rows(collocations.collocations(as_docs(spark, docs).repartition(3), least=least, most=None))
    assert got == brute_phrases(docs, least)


def test_first_phrases_of_each_language(spark):
    docs = story(5)
    got = phrase_rows(collocations.collocations(as_docs(spark, docs), least=3, most=7))
    assert got == brute_phrases(docs, 3, most=7) and max(r[1] for r in got) == 7


def test_phrases_of_shallow_trees_and_empty_tables(spark):
    docs = story(6, docs=20)
    assert phrase_rows(collocations.collocations(as_docs(spark, docs), least=2, most=None, depth=2)) == brute_phrases(docs, 2, depth=2)
    assert collocations.collocations(as_docs(spark, docs).filter("false")).count() == 0
    assert collocations.collocations(as_docs(spark, [(None, None), ("", "en")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**13
    words = spark.createDataFrame([("en", "x", 1, 3 * big), ("en", "y", 2, 7 * big + 1)], "lang string, word string, id long, f long")
    phrases = spark.createDataFrame([([1, 2], 2 * big + 3)], "phrase array<long>, f long")
    row = collocations.score_phrases(phrases, words).first()
    assert row.score == 1000 * (2 * big + 3) * (10 * big + 1) // (3 * big * (7 * big + 1))


def test_phrases_do_not_pass_the_driver(spark, folder):
    """Stored phrases look small enough to broadcast; only the words of each language, a row for each, may be."""
    phrases = spark.createDataFrame([([1, 2], 4)], "phrase array<long>, f long")
    words = spark.createDataFrame([("en", "x", 1, 6), ("en", "y", 2, 7)], "lang string, word string, id long, f long")
    for name, df in (("phrases", phrases), ("words", words)):
        df.write.parquet(f"{folder}/{name}")
    scored = collocations.score_phrases(spark.read.parquet(f"{folder}/phrases"), spark.read.parquet(f"{folder}/words"), least=1)
    joins = re.findall(r"\w+Join.*", plan_of(scored).split("== Physical Plan ==")[1])
    assert sum("BroadcastHashJoin [lang" in j for j in joins) == sum("Broadcast" in j for j in joins) <= 1 and len(joins) >= 4
    assert scored.count() == 1
    plan = plan_of(collocations.collocations(as_docs(spark, story(8, docs=20)), least=2)).split("== Physical Plan ==")[1]
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2


def test_words_that_share_a_number_take_another_seed(spark, monkeypatch):
    true = collocations._number
    monkeypatch.setattr(collocations, "_number", lambda lang, word, seed: 7 if seed == 0 else true(lang, word, seed))
    docs = story(7, docs=10)
    seeds = []
    kept = collocations.count_words
    monkeypatch.setattr(collocations, "count_words", lambda *a: seeds.append(kept(*a)) or seeds[-1])
    assert phrase_rows(collocations.collocations(as_docs(spark, docs), least=3, most=None)) == brute_phrases(docs, 3)
    assert seeds[0][1] == 1


def test_blocks_of_suffixes_round_trip():
    rng = np.random.default_rng(0)
    for size, n in ((3, 1), (300, 500), (100_000, 90_000)):
        ids = np.concatenate([[0], rng.integers(-(2**63), 2**63, size)])
        rows_, counts = collocations._summed(rng.integers(0, len(ids), (n, 5)))
        counts = counts * rng.choice([1, 255, 256, 10**12], len(counts))
        own, got, back = collocations._unpack(collocations._pack(ids, rows_, counts))
        assert (own[got] == ids[rows_]).all() and (back == counts).all()


def test_groups_are_summed_as_they_come(spark, monkeypatch):
    """Blocks of a group beyond its budget are merged in between; groups outnumber partitions."""
    docs = story(8)
    for group in (1, 50):
        monkeypatch.setattr(collocations, "GROUP", group)
        monkeypatch.setattr(collocations, "CHUNK", 300)
        assert phrase_rows(collocations.collocations(as_docs(spark, docs), least=4, most=None)) == brute_phrases(docs, 4)


# -- conversations

HARD = [
    r"\### Assistant: </turn> ok", "### User:\n", "</turn>\n", "\\", "\\\\", "###", "####", "# ## ###", "<</turn>>", "</turn", "a\n\nb", "", "😀é", "\\/turn>", "#\\##", "<\\/turn>",
    "### System:\nx</turn>\n### Assistant:\ny</turn>\n", "x" * 300_000, "#" * 5000, "\\" * 5000, "</turn>" * 2000, ":\n", "role-00", "$1 \\1",
]
TURN = "conv_id long, turn long, role string, text string, formatted int, segments int, n_turns int"


def spoken(spark, turns):
    return spark.createDataFrame([(*t, 1, 2, 3) for t in turns], TURN)


def test_conversations_read_back(spark):
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "### User:\n</turn>\n", "é:\n"]
    turns = [(c, k, rng.choice(roles), rng.choice([*HARD, None])) for c in range(60) for k in range(rng.randint(1, 9))]
    turns += [(100 + i, k, "user" if k % 2 == 0 else "assistant", t) for i, t in enumerate(HARD) for k in range(2)]
    turns += [(None, 0, "user", "null id"), (900, None, "user", "null turn first"), (900, 0, "assistant", "b"), (901, 0, "user", "same"), (901, 0, "user", "same")]
    df = spoken(spark, turns)
    got = chat_format.format_chats(df).withColumns({"turns": chat_format.read_chats(F.col("formatted")), "loss": chat_format.loss_text(F.col("segments"))}).collect()
    wanted = collections.defaultdict(list)
    for c, k, role, text in turns:
        wanted[c].append(((k is not None, k or 0), role or "", text or ""))
    assert len(got) == len(wanted)
    for r in got:
        own = [t[1:] for t in sorted(wanted[r.conv_id])]
        assert [tuple(t) for t in r.turns] == own and r.n_turns == len(own)
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.loss == "".join(text for role, text in own if role == "assistant")
        assert len(re.findall(r"</turn>\n", r.formatted)) == len(own) == r.formatted.count("### ")


@pytest.mark.parametrize(
    "roles, bad", [("ua", None), ("sua", None), ("uaua", None), ("u", 1), ("uau", 3), ("au", 0), ("sa", 1), ("uua", 1), ("usa", 1), ("uaa", 2), ("s", 1), ("uasua", 2), ("ux", 1), ("xua", 0)]
)
def test_order_of_turns(spark, roles, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "x": "tool"}
    got = chat_format.format_chats(spoken(spark, [(1, k, names[r], "t") for k, r in enumerate(roles)])).first()
    assert (got.bad_turn, got.valid) == (bad, bad is None)


def test_templates(spark):
    other = chat_format.Template(
        names={"human": "H", "bot": "B", "tool": "T"}, trained=("bot", "tool"), follows={"": ("human",), "human": ("bot",), "bot": ("tool", "human"), "tool": ("bot",)},
        ends=("bot", "tool"), opening="<|", closing="|>", footer="<|end|>",
    )
    df = spoken(spark, [(1, 0, "human", "<|B|> <|end|> \\<|"), (1, 1, "bot", "b<|"), (1, 2, "tool", "|>t"), (2, 0, "bot", "x")])
    got = {r.conv_id: r for r in chat_format.format_chats(df, template=other).withColumns({"t": chat_format.read_chats(F.col("formatted"), other), "l": chat_format.loss_text(F.col("segments"))}).collect()}
    assert [tuple(t) for t in got[1].t] == [("human", "<|B|> <|end|> \\<|"), ("bot", "b<|"), ("tool", "|>t")]
    assert got[1].l == "b<||>t" and got[1].valid and got[2].bad_turn == 0
    for wrong in ({"opening": "\\#"}, {"footer": "x"}, {"closing": ""}, {"names": {"a": "X", "b": "X"}}, {"names": {"a": "role-1"}}, {"names": {"a": "###"}}):
        with pytest.raises(ValueError):
            chat_format.Template(**wrong)


def test_formatting_stays_in_the_jvm(spark):
    plan = chat_format.format_chats(spoken(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow")) and plan.count("Exchange hashpartitioning") == 1


def test_empty_conversations(spark):
    df = spoken(spark, [])
    assert chat_format.format_chats(df).count() == 0
    assert rows(spark.createDataFrame([(None,), ("",)], "f string").select(F.size(chat_format.read_chats(F.col("f"))))) == [(None,), (0,)]


def test_query_of_the_given_conversations(spark):
    told = collections.defaultdict(list)
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: r.turn):
        told[r.conv_id].append((r.role, r.text or ""))
    told[-7] = [("user", HARD[0]), ("assistant", HARD[0])]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in queries.op13_chat_format(spark, SF).collect():
        own = told.pop(r.conv_id)
        loss = "".join(text for role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{role}\n{text}\n" for role, text in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert not told
