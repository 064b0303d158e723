"""How filters interact: every order of a set of filters applied to a corpus, by a recursive common table expression.

Each document becomes a mask with a bit per filter that it fails; documents are counted by part, mask and labels
(cells). A recursive query extends prefixes of filter letters by letters not yet used: it joins the masks that occur,
at most 2 to the number of filters, carries the bits applied so far, and every level of the recursion says for each
mask what that step does to it (kept, removed, redundant). Those few rows meet the cells of all parts once; the rows
of a level are then the metrics of that step, and each prefix stands for all full orders that begin with it.

Edge cases: a null text is empty; a null part is the empty string; a null id has no smaller one and no label; rows that
repeat an id and a text are equal rows, none of which has a smaller id; several labels of a document count if any of
them is 1. Without documents there are no parts and no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

BLANKS = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"


def default_failures(text: Column) -> dict[str, Column]:
    """The conditions of the filters that look at a text alone, by letter; they are true where a document fails."""
    bare = F.trim(text, F.lit(BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


#: The filter that fails for a text which a smaller id has too.
REPEATED = "E"


def failure_mask(failures: dict[str, Column]) -> Column:
    """The bits of the failing filters, the first filter's lowest."""
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures.values())), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang", failures=default_failures) -> tuple[DataFrame, str]:
    """(part, mask, n, good, toxic), and the letters in the order of the mask's bits.

    Equal texts are told by their SHA-256. Copies are counted by (text, id), then by (text, part, labels) before all rows of
    a text meet, so that a text with many copies is a few rows there.
    """
    text = F.coalesce("text", F.lit(""))
    conditions = failures(F.col("__text"))
    letters = "".join(conditions) + REPEATED
    row = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("__text"))
    row = row.select("doc_id", "part", F.unhex(F.sha2(F.col("__text").cast("binary"), 256)).alias("same"), failure_mask(conditions).alias("own"))
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c) for c in ("quality", "toxic")))
    known = row.join(told, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "part", "same", "own", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")))
    by = ["same", "own", "part", "quality", "toxic"]
    each = known.groupBy("doc_id", *by).agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    some = written(each.groupBy(*by).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without"), first.alias("first")), "copies")
    least = some.groupBy("same").agg(F.min("first.doc_id").alias("least")).withColumnRenamed("same", "__same")
    met = some.join(least, F.col("same") == F.col("__same"))
    fresh = F.col("without") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = met.select("part", "quality", "toxic", F.inline(F.array(
        F.struct(F.col("own").alias("mask"), fresh.alias("n")), F.struct(F.col("own").bitwiseOR(F.lit(1 << (len(letters) - 1))).alias("mask"), (F.col("n") - fresh).alias("n")),
    )))
    counted = split.where("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(a) for c, a in (("quality", "good"), ("toxic", "toxic"))))
    return counted, letters


#: One row for each prefix of letters and mask cell; `unused` has the letters that may follow a set of applied bits. A level emits what its step, the filter `letter`, does to the mask.
STEPS_SQL = """
WITH RECURSIVE steps(prefix, letter, step, applied, mask, kept, removed, redundant, alone) AS (
  SELECT '', '', 0, 0, m.mask, true, false, false, false FROM {masks} m
  UNION ALL
  SELECT concat(s.prefix, f.letter), f.letter, s.step + 1, s.applied | f.bit, s.mask,
    (s.mask & (s.applied | f.bit)) = 0, (s.mask & s.applied) = 0 AND (s.mask & f.bit) <> 0,
    (s.mask & s.applied) <> 0 AND (s.mask & f.bit) <> 0, s.mask = f.bit
  FROM steps s JOIN {unused} f ON s.applied = f.applied
) SELECT * FROM steps WHERE step > 0
"""


def prefix_steps(masks: DataFrame, letters: str) -> DataFrame:
    """The recursion over the masks that occur: prefixes of all lengths x masks, whatever the corpus holds."""
    spark = masks.sparkSession
    unused = [(applied, x, 1 << i) for applied in range(1 << len(letters)) for i, x in enumerate(letters) if not applied >> i & 1]
    return spark.sql(STEPS_SQL, unused=spark.createDataFrame(unused, "applied int, letter string, bit int"), masks=masks)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", failures=default_failures) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, and shapley, what the step's filter removes in all orders of the part taken together."""
    counted, letters = cells(docs, labels, part, failures)
    cell = written(counted, "cells")
    # At most one row a mask: a bound by the number of filters alone, so both small sides are proven to be small.
    steps = written(prefix_steps(cell.select("mask").distinct(), letters), "steps")
    of = lambda condition, value="n": F.sum(F.when(F.col(condition), F.col(value)).otherwise(0))
    told = cell.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(
        of("kept").alias("kept"), of("removed").alias("removed"), of("redundant").alias("redundant"), of("alone").alias("unique_fails"), of("removed", "good").alias("good_lost"), of("removed", "toxic").alias("toxic_lost"),
    )
    told = written(told, "prefixes")
    orders = steps.where(F.length("prefix") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    rest = F.element_at(F.array(*(F.lit(math.factorial(k)) for k in range(len(letters)))), F.lit(len(letters) + 1) - F.col("step"))
    shapley = told.groupBy("part", "letter").agg(F.sum(F.col("removed") * rest).alias("shapley"))
    begun = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")).select("filter_order", F.expr("left(filter_order, step)").alias("prefix"))
    full = told.join(F.broadcast(begun), "prefix").join(shapley, ["part", "letter"])
    return full.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
