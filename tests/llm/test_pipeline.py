"""The pipeline, stage by stage, against plain Python; and the entry point with and without the package."""

import subprocess
import sys
from pathlib import Path

import brute
import corpus_pipeline
from conftest import SF

from bizpulse.llm import packing, queries

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert out.columns == docs.columns
            after = {r.doc_id: r.text for r in out.collect()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        if name == "quality":
            assert set(after) < set(before)
            lost = [labels[i] for i in set(before) - set(after) if i in labels]
            assert sum(lost) <= 0.01 * sum(labels.values()) and len(lost) > 0.5 * (len(labels) - sum(labels.values()))
        elif name == "lines":
            assert after == {i: text for i, (_, _, text) in brute.line_dedup(before).items()}
        elif name == "near_copies":
            classes = brute.near(before)
            assert set(after) == {i for i in before if classes[i][0] == i}
        elif name == "secrets":
            assert set(after) == set(before) and not any(brute.base_secrets(t) for t in after.values())
            assert all(after[i] == t for i, t in before.items() if not brute.base_secrets(t))
        else:
            ids = packing._tokenizer(queries.tokenizer_file("word_bpe_49k.json"))
            assert sum(r.length for r in out.collect()) == sum(len(ids.encode(t, add_special_tokens=False).ids) + 1 for t in before.values())
        docs = out


def test_packed_ids_are_stored(spark, folder):
    """Each text's ids can be put together again from what the last stage stores."""
    import zlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    corpus_pipeline.pack(spark, docs, SF).write.parquet(f"{folder}/packed")
    ids = packing._tokenizer(queries.tokenizer_file("word_bpe_49k.json"))
    whole = {}
    for r in sorted(spark.read.parquet(f"{folder}/packed").collect(), key=lambda r: (r.doc_id, r.start)):
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        whole[r.doc_id] = whole.get(r.doc_id, b"") + r.ids
    for r in docs.collect():
        wanted = ids.encode(r.text or "", add_special_tokens=False).ids
        got = [int.from_bytes(whole[r.doc_id][k : k + 4], "little") for k in range(0, 4 * len(wanted), 4)]
        assert got == wanted and len(whole[r.doc_id]) == 4 * len(wanted) + 4


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_entry_without_the_package(tmp_path):
    """A copy of the repository without the package, its tests and the pipeline still imports and lists the other queries."""
    import shutil

    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    count, *rest = said.stdout.split()
    assert int(count) >= 60 and rest == ["False", "False"]
