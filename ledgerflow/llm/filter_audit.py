"""How five filters interact: every order of them audited by higher-order SQL folds.

A document is a mask of the filters that it fails, so a part (a language) is at most 32 *mask
cells* with the weights documents, good documents and toxic documents. Each cell is folded over
the array of all 120 orders, a literal of fixed size that goes to every task with the plan:
``transform`` takes an order, ``aggregate`` walks its five filters while the cell is alive, and
the outcome is an array of 600 weighted structs, one for each order and step. The arrays of a
part are merged by sums element by element, and only then become rows.

All of it is SQL: no Python runs in a task. The texts are read once; what is shuffled is a
digest and a mask for each document.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, pick

#: The filters, by letter; bit i of a mask is set if a document fails the i-th. (Fixed values.)
LETTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
MARKS = "[#$%&*|]"
#: White space of the contract: blank and the bytes 9 to 13.
BLANKS = "[\\x20\\x09-\\x0D]+"

ORDERS = ["".join(p) for p in permutations(LETTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _own_mask(text: Column) -> Column:
    """The failures that a text shows by itself (A to D), as bits 0 to 3."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, points = F.size(words), F.char_length(text)
    distinct = F.size(F.array_distinct(words))
    fails = [
        n < LEAST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT_PERCENT * n.cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS_PERCENT * points.cast("long"),
        text.rlike(MARKS),
    ]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    return mask


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): documents by the filters they fail, one row for equal ids, parts and masks.

    Filter E compares texts by their SHA-256 over the whole table: the smallest id of a text is a
    minimum that tasks combine before the shuffle, and documents meet it on (text, id), so
    a text that a third of all documents share is not gathered anywhere.
    """
    text = F.coalesce("text", F.lit(""))
    slim = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"), part=(lang_col, "string")).select(
        "doc_id", F.coalesce("part", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"), _own_mask(text).alias("own")
    )
    slim = materialize(slim, "audit-masks")
    rows = slim.groupBy("same", "doc_id", "part", "own").agg(F.count("*").alias("n"))
    first = slim.groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    mask = F.col("own") + F.when(copy, 16).otherwise(0)
    return rows.join(first, ["same", "doc_id"], "left").groupBy("doc_id", "part", mask.alias("mask")).agg(F.sum("n").alias("n"))


def mask_cells(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows a part."""
    marked = (
        pick(labels, doc_id=(id_col, "long"), quality=("quality", "int"), toxic=("toxic", "int"))
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    )
    return (
        masks.join(marked, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def _fold(order: Column) -> Column:
    """One cell through one order: an array of five structs (filter, COUNTS)."""
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<filter:string,{','.join(c + ':bigint' for c in COUNTS)}>>").alias("out"))

    def step(state: Column, letter: Column) -> Column:
        bit = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(LETTERS) for x in (c, 1 << i)]), letter)
        failed, alive = F.col("mask").bitwiseAND(bit) != 0, state["alive"]
        removed = alive & failed
        row = F.struct(
            letter.alias("filter"),
            F.when(alive & ~failed, F.col("n")).otherwise(zero).alias("kept"),
            F.when(removed, F.col("n")).otherwise(zero).alias("removed"),
            F.when(~alive & failed, F.col("n")).otherwise(zero).alias("redundant"),
            F.when(F.col("mask") == bit, F.col("n")).otherwise(zero).alias("unique_fails"),
            F.when(removed, F.col("good")).otherwise(zero).alias("good_lost"),
            F.when(removed, F.col("toxic")).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((alive & ~failed).alias("alive"), F.concat(state["out"], F.array(row)).alias("out"))

    return F.aggregate(F.split(order, ""), start, step, lambda s: s["out"])


def _sums(arrays: Column) -> Column:
    """Element by element sums of arrays of count structs."""

    def add(a: Column, b: Column) -> Column:
        return F.struct(a["filter"].alias("filter"), *[(a[c] + b[c]).alias(c) for c in COUNTS])

    return F.aggregate(F.slice(arrays, 2, F.size(arrays)), arrays[0], lambda acc, x: F.zip_with(acc, x, add))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step: part, filter_order, step, COUNTS, shapley (longs).

    Counts are of documents within the part: kept after the step, removed by it, redundant
    (fail its filter, removed earlier), unique_fails (fail no other filter), good_lost and
    toxic_lost (removed here, labelled so), and shapley (removed by its filter, summed over all orders).

    Defined cases: a null text is an empty one, a null lang the part ''; a null id has no smaller id, so it
    never fails E, and no label; rows that repeat an id and its text are no copies of
    each other; a label given several times holds if one of its rows says so, and labels of unknown ids are ignored;
    very long texts are judged whole; extra columns are ignored; an empty table gives no rows.
    """
    cells = mask_cells(failure_masks(docs), labels)
    orders = F.lit(ORDERS)
    folded = cells.select("part", F.flatten(F.transform(orders, _fold)).alias("steps"))
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", _sums(F.col("cells")).alias("steps"))  # 32 cells at most

    def shapley(letter: str) -> Column:
        mine = F.filter("steps", lambda s: s["filter"] == letter)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, s: acc + s["removed"])

    totals = F.create_map(*[x for c in LETTERS for x in (F.lit(c), shapley(c))])
    rows = merged.select("part", totals.alias("totals"), F.posexplode("steps").alias("at", "s"))
    return rows.select(
        "part",
        F.element_at(orders, F.floor(F.col("at") / len(LETTERS)).cast("int") + 1).alias("filter_order"),
        (F.col("at") % len(LETTERS) + 1).cast("int").alias("step"),
        *[F.col("s")[c].alias(c) for c in COUNTS],
        F.element_at("totals", F.col("s")["filter"]).alias("shapley"),
    )


#: The same result in DuckDB: a join of documents, orders and steps in place of folds.
ORACLE_SQL = """
WITH letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
),
masks AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM texts
),
marked AS (SELECT doc_id, bool_or(quality = 1) AS is_good, bool_or(toxic = 1) AS is_toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (is_good) AS good, count(*) FILTER (is_toxic) AS toxic
  FROM masks LEFT JOIN marked USING (doc_id) GROUP BY part, mask
),
places AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, bit,
         (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE contains(substr(filter_order, 1, step - 1), x.letter)) AS before
  FROM orders, range(1, 6) AS steps(step), letters
  WHERE letter = substr(filter_order, step, 1)
),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (before | bit)::INT = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before::INT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before::INT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, places GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""
