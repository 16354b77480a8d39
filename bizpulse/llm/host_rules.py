"""Quality rules on documents and on the hosts they come from.

Every document gets counts and a verdict of each rule. Failures of each rule are counted by host, each host's rate is shrunk
towards the rule's mean by a beta prior fitted to all hosts, and the verdict on the host is joined back to its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import binary_texts, free_name, text_batches
from bizpulse.session import materialize

WINDOW_WORDS = 5
SYMBOLS = b"#*$%&|<>"
#: A host is rejected if its shrunk failure rate by any rule exceeds this.
HOST_LIMIT = 0.5
#: Rules by name, as SQL over the counts: a document fails one where it holds. Those of BASE_RULES also decide on the document.
RULES = {
    "short": "n_words < 10",
    "repeated": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE_RULES = ("short", "repeated")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """How many words lie in a window of `width` words that occurs at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    size = len(number)
    if size == len(words):
        return 0
    code = ids[:n]
    for k in range(1, width):  # exact: after each word, the different beginnings are numbered anew
        code = np.unique(code * size + ids[k : k + n], return_inverse=True)[1]
    found = np.bincount(code)[code] > 1
    if not found.any():
        return 0
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(found)
    np.add.at(covered, starts, 1)
    np.add.at(covered, np.minimum(starts + width, len(words)), -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in binary_texts(batch.column(batch.num_columns - 1)):
            words = text.split()
            joined = b"".join(words)
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            lines = Counter(line for line in text.split(b"\n") if line and not line.isspace())
            full = sum(lines.values())
            rows.append((len(words), len(joined.translate(None, _CONTINUATION)), symbols, full - len(lines), repeated_words(words), full))
        names = [*COUNTS, "n_lines"]
        counts = np.array(rows, dtype=np.int64).reshape(-1, len(names))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(counts[:, k]) for k in range(len(names)))], [*batch.schema.names[:-1], *names]
        )


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` with the counts, `n_lines`, a column `failed_<rule>` for each rule, and `base_failed`, one row per row
    of `docs`, repeated rows included.

    Words are runs of anything but ASCII white space; null text has none. n_symbols counts `#*$%&|<>` in the whole text,
    n_dup_lines the lines with a word that equal an earlier line, n_lines all lines with a word, n_repeat_words the words in
    windows of five words found at least twice in the text, first ones included. A document fails with fewer than 10 words or
    when more than a fifth of its words repeat; a symbol for ten words or three repeated lines of ten count for hosts only.
    """
    text_batches(docs.sparkSession)
    kept = docs.select(*keep, F.col(text_col).alias(free_name(docs, "rule_text")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), *(f"{c} long" for c in [*COUNTS, "n_lines"])])
    measured = kept.mapInArrow(_measured, schema).withColumns({f"failed_{rule}": F.expr(sql) for rule, sql in RULES.items()})
    return measured.withColumn("base_failed", F.expr(" OR ".join(f"failed_{rule}" for rule in BASE_RULES)))


def host_rates(measured: DataFrame, host: str, rules: Sequence[str] = tuple(RULES)) -> DataFrame:
    """One row per host: `docs`, and for each rule its failures, `failures_<rule>`, and `rate_<rule>`, the failure rate shrunk by
    the rule's own empirical beta prior.

    The prior's mean is the mean of the hosts' rates; its weight comes from their variance beyond what counting alone makes
    (method of moments). Of `noise`, the mean of 1 / documents, the variance of the rates holds tau2 * (1 - noise) +
    mean * (1 - mean) * noise, so the surplus is divided by 1 - noise. Without a surplus, or where no host has two documents,
    all hosts are alike and the weight is large. The priors are one row; it is fetched here, so `measured` should be stored.
    """
    failures = [F.sum(F.col(f"failed_{r}").cast("long")).alias(f"failures_{r}") for r in rules]
    hosts = measured.groupBy(host).agg(F.count("*").alias("docs"), *failures)
    moments = [F.avg(1 / F.col("docs")).alias("noise"), F.count("*").alias("hosts")]
    for rule in rules:
        share = F.col(f"failures_{rule}") / F.col("docs")
        moments += [F.avg(share).alias(f"mean_{rule}"), F.var_samp(share).alias(f"variance_{rule}")]
    prior = hosts.agg(*moments).first()
    noise, rates = prior["noise"] or 0.0, []
    for rule in rules:
        mean, variance = prior[f"mean_{rule}"] or 0.0, prior[f"variance_{rule}"] or 0.0
        spread = mean * (1 - mean)
        # The mean's own variance comes back to `spread`; without it hosts of one document each would seem to differ.
        surplus = (variance - (spread + variance / max(prior["hosts"], 1)) * noise) / max(1 - noise, 1e-6)
        surplus = max(surplus, spread * 1e-4, 1e-12)
        weight = max(spread / surplus - 1, 1.0)
        rates.append(((F.col(f"failures_{rule}") + F.lit(mean * weight)) / (F.col("docs") + F.lit(weight))).alias(f"rate_{rule}"))
    return hosts.select(host, "docs", *(f"failures_{r}" for r in rules), *rates)


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """`id_col`, `host`, the columns of `measure`, `host_rate` and `kept`, one row per row of `docs`; repeated rows count each.

    `host_rate` is the largest of the host's shrunk failure rates by rule. `kept` is false if the document fails or that exceeds
    `limit`. Documents whose host is null or empty share the empty one. The text is read once; counts go through the shared scratch folder. The rates are
    stored too, so that their size is known to the planner, and a join that has to shuffle meets two exchanges, of which
    adaptive execution splits the hot hosts' side.
    """
    named = docs.select(id_col, F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("rule_text"))
    measured = materialize(measure(named, [id_col, "host"], "rule_text"), "rules")
    rates = host_rates(measured, "host").select("host", F.greatest(*(f"rate_{r}" for r in RULES)).alias("host_rate"))
    joined = measured.join(materialize(rates, "host-rates"), "host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= limit))
