"""Daily state from which monthly fact rows are merged, so a month's end reads one day of events and small tables.

Sums are kept per business and day. Distinct counts are kept as bitmaps: ids of reviews and users get numbers, dense from 1,
once and for all, and a day's ids of a business are the bits of their numbers, cut into buckets of 32768 bits. Of a bucket only words of 64 bits
that have some are kept, so a bitmap is never larger than a few bytes an id. The bitmaps of a month's days are joined by OR, word by
word, and counting bits counts ids. A day that is loaded again replaces its own state and no other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.functions.dates import period_month
from bizpulse.operators.facts import REVIEW_MEASURES, TIP_MEASURES, to_narrow
from bizpulse.schemas import DISTINCT_USERS_REVIEW, DISTINCT_USERS_TIP, FACT_COLUMNS, MONTHLY, REVIEW_COUNT
from bizpulse.session import materialize

#: What an id names, and the measures that count it.
REVIEW, USER = "review", "user"
SUMS = ("stars", "rated", "useful", "funny", "cool", "tips", "compliments")


def event_ids(reviews: DataFrame, tips: DataFrame) -> DataFrame:
    """Rows (business_id, day, measure, kind, id), one for each id that an event carries for a distinct count. Ids must not be
    null, which silver guarantees."""

    def ids(events: DataFrame, counted: Mapping[int, tuple[str, str]]) -> DataFrame:
        tags = [F.struct(F.lit(m).alias("measure"), F.lit(kind).alias("kind"), F.col(c).alias("id")) for m, (kind, c) in counted.items()]
        return events.select("business_id", F.to_date("date").alias("day"), F.explode(F.array(*tags)).alias("t")).select("business_id", "day", "t.*")

    of_reviews = ids(reviews, {REVIEW_COUNT: (REVIEW, "review_id"), DISTINCT_USERS_REVIEW: (USER, "user_id")})
    return of_reviews.unionByName(ids(tips, {DISTINCT_USERS_TIP: (USER, "user_id")}))


def new_numbers(ids: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows (kind, id, number) for the ids (kind, id) that `known` lacks, numbered on from the largest number of their kind."""
    return numbers_of(ids, known)[1]


def numbers_of(ids: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rows (kind, id, number) for all ids (kind, id), and for those of them that `known` lacks, numbered on from the largest
    number of their kind.

    Numbers are dense without a global sort: rows are counted where they lie, one small row a task and kind, and each task
    goes on from the rows of those before it. `known` is read and moved once, and the ids are stored once.
    """
    own = ids.select("kind", "id").distinct()
    if known is None:
        own = own.withColumn("number", F.lit(None).cast("long"))
    else:
        own = own.join(known.select("kind", "id", "number").hint("merge"), ["kind", "id"], "left")
    # New ids of a kind follow each other within a task, so their places tell their ranks.
    lying = own.sortWithinPartitions(F.col("number").isNull(), "kind").withColumn("place", F.monotonically_increasing_id())
    met = materialize(lying.select("kind", "id", "number", "place"), "met-ids")
    placed = met.filter("number IS NULL").drop("number")
    task = F.shiftright("place", 33)
    of_tasks = placed.groupBy("kind", task.alias("task")).agg(F.count("*").alias("n"), F.min("place").alias("first")).collect()
    sizes, first = {(r.kind, r.task): r.n for r in of_tasks}, {(r.kind, r.task): r["first"] for r in of_tasks}
    last = {} if known is None else {r.kind: r.n for r in known.groupBy("kind").agg(F.max("number").alias("n")).collect()}
    before, at = [], dict(last)
    for kind, of_task in sorted(sizes):
        before.append((kind, of_task, at.get(kind, 0) - first[kind, of_task] + 1))
        at[kind] = at.get(kind, 0) + sizes[kind, of_task]
    offsets = placed.sparkSession.createDataFrame(before, "kind string, task long, offset long")
    numbered = placed.withColumn("task", task).join(F.broadcast(offsets), ["kind", "task"])
    new = numbered.select("kind", "id", (F.col("offset") + F.col("place")).cast("long").alias("number"))
    return (new if known is None else met.filter("number IS NOT NULL").drop("place").unionByName(new)), new


#: Rows that a day's part has, about: so many go to one task and one file.
DAY_PART = 500_000


def _dealt_by_day(rows: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows` dealt out by day and, within a day, by `keys` in as many parts as its rows in `sizes` ask for, which column `_part`
    numbers. What is grouped by both and the keys follows there and lies by its days, so its write needs no other shuffle."""
    parts = sizes.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / DAY_PART).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64(*keys), F.col("_parts")).cast("int")
    return rows.join(F.broadcast(parts), "day").withColumn("_part", part).drop("_parts").repartition("day", "_part")


def day_bitmaps(ids: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows (day, business_id, measure, bucket, words, bits) of the ids of `event_ids`, by their numbers: the places of a bucket's
    words that have bits, and these words one after another, eight bytes each.

    A bucket holds 32768 ids at most, so with distinct ids no task has a hot one. Ids that repeat are counted once. Rows lie by their
    days (see `_dealt_by_day`).
    """
    key = ["day", "business_id", "measure", "bucket"]
    numbered = ids.join(numbers.hint("merge"), ["kind", "id"])
    position = F.bitmap_bit_position("number").cast("short").alias("position")
    placed = numbered.select("day", "business_id", "measure", F.bitmap_bucket_number("number").alias("bucket"), position)
    dealt = _dealt_by_day(placed, ids, key[1:])
    own = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("position").bitwiseAND(F.lit(63)).cast("int"))
    words = dealt.groupBy("_part", *key, F.shiftright("position", 6).cast("short").alias("word")).agg(F.bit_or(own).alias("own"))
    listed = words.groupBy("_part", *key).agg(F.sort_array(F.collect_list(F.struct("word", "own"))).alias("_words"))
    digits = F.transform("_words", lambda w: F.lpad(F.hex(w["own"]), 16, "0"))
    return listed.select(*key, F.col("_words.word").alias("words"), F.unhex(F.array_join(digits, "")).alias("bits"))


def bitmap_words(bitmaps: DataFrame) -> DataFrame:
    """The words of `day_bitmaps` in a row each: its columns with `word`, the place, and `own`, the bits as a number."""
    rest = [c for c in bitmaps.columns if c not in ("words", "bits")]
    each = bitmaps.select(*rest, "bits", F.posexplode("words").alias("_at", "word"))
    digits = F.hex(F.substr("bits", F.col("_at") * 8 + 1, F.lit(8)))
    return each.select(*rest, "word", F.conv(digits, 16, -10).cast("long").alias("own"))


def day_sums(reviews: DataFrame, tips: DataFrame) -> DataFrame:
    """Rows (day, business_id, sums ...): what a day adds to each business's sums. A sum without rows is null. Rows lie by their
    days (see `_dealt_by_day`)."""
    day, counted = F.to_date("date").alias("day"), ("stars", "useful", "funny", "cool")
    of_reviews = reviews.select(day, "business_id", *counted, F.lit(True).alias("reviewed"))
    of_tips = tips.select(day, "business_id", F.coalesce("compliment_count", F.lit(0)).alias("compliments"), F.lit(False).alias("reviewed"))
    both = of_reviews.unionByName(of_tips, allowMissingColumns=True)
    sums = {
        **{c: F.sum(c) for c in (*counted, "compliments")},
        "rated": F.when(F.bool_or("reviewed"), F.count("stars")),
        "tips": F.nullif(F.count_if(~F.col("reviewed")), F.lit(0)),
    }
    grouped = _dealt_by_day(both, both, ["business_id"]).groupBy("day", "_part", "business_id")
    added = grouped.agg(*[sums[c].cast("long").alias(c) for c in SUMS], F.bool_or("reviewed").alias("reviewed"))
    return added.drop("_part")


def monthly_from_state(sums: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Monthly fact rows of the months whose days the state holds, as `fact_for_period` has them."""
    month = F.last_day("day").alias("day")
    # Both counts follow where a business's bitmaps of a measure are dealt to; they are a few bytes an id.
    dealt = bitmap_words(bitmaps.withColumn("day", F.last_day("day")).repartition("business_id", "day", "measure"))
    merged = dealt.groupBy("business_id", "day", "measure", "bucket", "word").agg(F.bit_or("own").alias("own"))
    counts = merged.groupBy("business_id", "day", "measure").agg(F.sum(F.bit_count("own")).cast("double").alias("units"))

    totals = sums.groupBy("business_id", month).agg(*[F.sum(c).alias(c) for c in SUMS], F.bool_or("reviewed").alias("reviewed"))
    wide = totals.select(
        "business_id", "day", "reviewed", (F.col("stars").cast("double") / F.nullif(F.col("rated"), F.lit(0))).alias("avg_stars"),
        *[F.col(c).cast("double").alias(f"total_{c}") for c in ("useful", "funny", "cool")],
        F.col("tips").isNotNull().alias("tipped"), F.col("tips").cast("double").alias("tip_count"), F.col("compliments").cast("double").alias("compliment_count_sum"),
    )

    def narrow(rows: DataFrame, measures: Mapping[str, int], kept: Sequence[str]) -> DataFrame:
        return to_narrow(rows, ["business_id", "day", *kept], {k: v for k, v in measures.items() if k in wide.columns})

    # All measures unfold together, so the sums are moved once; a business has those of reviews or tips if it has such events.
    of_reviews, of_tips = (F.col("measure").isin([v for k, v in m.items() if k in wide.columns]) for m in (REVIEW_MEASURES, TIP_MEASURES))
    unfolded = narrow(wide, {**REVIEW_MEASURES, **TIP_MEASURES}, ["reviewed", "tipped"]).filter((of_reviews & F.col("reviewed")) | (of_tips & F.col("tipped")))
    rows = counts.select("business_id", "day", "measure", "units").unionByName(unfolded.drop("reviewed", "tipped"))
    return rows.withColumns({"granularity": F.lit(MONTHLY), "period_month": period_month(F.col("day"))}).select(*FACT_COLUMNS)
