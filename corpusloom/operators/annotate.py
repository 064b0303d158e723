"""Labelling sections: contents lists, front and back matter, document types, a trainable classifier."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import SPACE, python_lines, strip

#: Labels (fixed values): contents, references, body, appendix, front matter, other.
CONTENTS, REFERENCES, BODY, APPENDIX, FRONT, OTHER = "π", "β", "κ", "α", "ε.σ.", "άλλο"
FRONT_LIMIT = 300
INDEX_NUMBERS, INDEX_EQUAL, INDEX_HIGHEST, INDEX_FEW = 7, 4, 400, 4


_LETTER = "[A-Za-zΑ-Ωα-ω]"


def contents_rows(text: Column) -> Column:
    """The table rows of a text, stripped; a row broken after its first part is joined with the next line."""
    every = F.transform(python_lines(text), strip)
    opens, ends = (lambda x: F.startswith(x, F.lit("|"))), (lambda x: F.endswith(x, F.lit("|")))
    broken = lambda x, after: opens(x) & ~ends(x) & ~opens(after) & ends(after)
    joined = F.zip_with(every, F.slice(every, F.lit(2), F.greatest(F.size(every), F.lit(1))), lambda x, after: F.when(broken(x, after), F.concat(x, F.lit(" "), after)).otherwise(x))
    return F.filter(joined, lambda x: opens(x) & ends(x))


def page_numbers(text: Column) -> Column:
    """The page numbers at the ends of table rows that look like entries of a contents list, in order.

    A row counts if its first half has a letter. In the second half the first of a range of numbers counts, or else
    the last whole number below 400; in either case no letter may follow.
    """
    collapsed = F.transform(contents_rows(text), lambda x: F.regexp_replace(F.regexp_replace(x, f"[{SPACE}]+", " "), r"(?:[._-]\s?){3,}", " "))

    def number(x: Column) -> Column:
        half = F.floor(F.length(x) / 2).cast("int")
        first, second = F.substr(x, F.lit(1), half), F.substr(x, half + 1, F.length(x))
        ranged = rf"(?U)^.*?\b(\d{{1,3}})(\s*-\s*\d{{1,3}}\b.*)\z"
        low = F.when(F.rlike(F.regexp_extract(second, ranged, 2), F.lit(f"^(?:(?!{_LETTER}).)+\\z")), F.regexp_extract(second, ranged, 1).try_cast("int"))
        single = F.regexp_extract_all(second, F.lit(rf"(?U)\b(\d{{1,3}}(?:\.\d+)?)\b(?=(?:(?!{_LETTER}).)*\z)"), 1)
        whole = F.filter(F.transform(single, lambda n: F.when(~F.contains(n, F.lit(".")), n.try_cast("int"))), lambda n: n < INDEX_HIGHEST)
        last = F.when(F.size(whole) > 0, F.element_at(whole, -1))
        return F.when(F.rlike(first, F.lit(_LETTER)), F.coalesce(F.when(low < INDEX_HIGHEST, low), last))

    return F.filter(F.transform(collapsed, number), lambda n: n.isNotNull())


def is_contents_list(text: Column) -> Column:
    """Whether seven page numbers in a row never fall, of which a fifth equal one begins anew, or, where all lines but
    one are table rows, four numbers and more never fall."""

    def judged(m: Column) -> Column:
        start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("same"), F.lit(0).alias("best"), F.lit(False).alias("fell"))

        def step(a: Column, n: Column) -> Column:
            equal = (n == a["last"]) & (a["same"] < INDEX_EQUAL)
            run = F.when(equal | (n > a["last"]), a["run"] + 1).otherwise(1)
            same = F.when(equal, a["same"] + 1).otherwise(1)
            return F.struct(n.alias("last"), run.alias("run"), same.alias("same"), F.greatest(a["best"], run).alias("best"), (a["fell"] | F.coalesce(n < a["last"], F.lit(False))).alias("fell"))

        def decided(end: Column) -> Column:
            n = F.size(m["numbers"])
            few = (m["rows"] >= m["lines"] - 1) & (n >= INDEX_FEW) & ~end["fell"]
            return F.when(n < INDEX_NUMBERS, few).otherwise(end["best"] >= INDEX_NUMBERS)

        return F.element_at(F.transform(F.array(F.aggregate(m["numbers"], start, step)), decided), 1)

    measured = F.struct(page_numbers(text).alias("numbers"), F.size(contents_rows(text)).alias("rows"), F.size(python_lines(text)).alias("lines"))
    found = F.element_at(F.transform(F.array(measured), judged), 1)
    return F.coalesce(F.contains(text, F.lit("|")) & found, F.lit(False))


def override_contents(sections: DataFrame, key: str = "doc_id", text: str = "content", label: str = "label") -> DataFrame:
    """Labels corrected near the front: detected contents lists are π while both running sums are small; once either
    has grown, π is no longer believed."""
    w = W.partitionBy(key).orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    early = (F.sum("section_length").over(w) <= FRONT_LIMIT) & (F.sum("section_propo").over(w) <= FRONT_LIMIT)
    listed = sections.withColumn("__listed", is_contents_list(F.col(text)))  # below the window, which then needs no text
    fixed = F.when(early & F.col("__listed"), CONTENTS).when(~early & (F.col(label) == CONTENTS), OTHER).otherwise(F.col(label))
    return listed.withColumn(label, fixed).drop("__listed")


def annotate_text(sections: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """Other sections become front matter, appendix or body by the first contents and the last references."""
    w = W.partitionBy(key)
    first = F.min(F.when(F.col(label) == CONTENTS, F.col("id"))).over(w)
    last = F.max(F.when(F.col(label) == REFERENCES, F.col("id"))).over(w)
    placed = F.when(F.col("id") < first, FRONT).when(F.col("id") > last, APPENDIX).otherwise(BODY)
    return sections.withColumn(label, F.when((first <= last) & (F.col(label) == OTHER), placed).otherwise(F.col(label)))


def annotate_chapters(sections: DataFrame, label: str = "label") -> DataFrame:
    return sections.withColumn(label, F.when(F.col(label).isin(CONTENTS, OTHER), BODY).otherwise(F.col(label)))


def with_document_types(docs: DataFrame, types: DataFrame, name: str = "filename") -> DataFrame:
    """Adds document_type from (filename, document_type) rows, matched as written, without extension, or with .md.

    Of several names for a file the one as written counts first. The map's size decides how Spark joins it.
    """
    clean = types.where(~F.coalesce(F.trim("document_type"), F.lit("")).isin("", "NA", "nan"))
    bare = F.regexp_replace("filename", r"\.[^.]*$", "")
    alias = F.explode(F.array(F.struct(F.col("filename").alias("n"), F.lit(0).alias("r")), F.struct(bare.alias("n"), F.lit(1).alias("r")), F.struct(F.concat(bare, F.lit(".md")).alias("n"), F.lit(2).alias("r"))))
    names = clean.select(alias.alias("a"), "document_type").groupBy(F.col("a.n").alias(name)).agg(F.min_by("document_type", F.col("a.r")).alias("document_type"))
    return docs.drop("document_type").join(names, name, "left")


def annotation_method(document_type: Column, methods: dict[str, str]) -> Column:
    if not methods:
        return F.lit("text")
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in methods.items() for x in kv]), document_type), F.lit("text"))


def annotate(sections: DataFrame, method: Column, key: str = "doc_id", label: str = "label") -> DataFrame:
    """Each document by its own method, text or chapter, in one pass."""
    by_text = annotate_text(sections.withColumn("__method", method).withColumn("__was", F.col(label)), key, label)
    chapter = F.when(F.col("__was").isin(CONTENTS, OTHER), BODY).otherwise(F.col("__was"))
    return by_text.withColumn(label, F.when(F.col("__method") == "chapter", chapter).otherwise(F.col(label))).drop("__method", "__was")


def classifier(vocabulary: int = 2000, max_iter: int = 100):
    """A pyspark.ml pipeline: header and text words by TF-IDF, with four flags, into linear SVMs one against the rest."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC, OneVsRest
    from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StringIndexer, VectorAssembler

    return Pipeline(stages=[
        StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep"),
        RegexTokenizer(inputCol="combined", outputCol="words", pattern=r"[^\p{L}\p{N}]+", minTokenLength=2),
        CountVectorizer(inputCol="words", outputCol="counts", vocabSize=vocabulary), IDF(inputCol="counts", outputCol="weighted"),
        VectorAssembler(inputCols=["weighted", "has_table", "has_list", "has_other", "has_text"], outputCol="features", handleInvalid="keep"),
        OneVsRest(classifier=LinearSVC(maxIter=max_iter), labelCol="label_index", featuresCol="features", predictionCol="predicted"),
    ])


def stratified_split(rows: DataFrame, label: str, key: str, shares: float | dict[str, float], out: str = "part") -> DataFrame:
    """Deals the rows of each label into named parts by their shares, in the order of a hash of the key.

    A number stands for train with that share and test with the rest. Ranks are split over buckets of the hash, as many
    as keep a bucket small, whose counts are summed up, so no label has to fit a task. Shares are decimals as written, so
    that a limit halfway between two ranks is rounded up as such; null labels are a label, null keys come last.
    """
    shares = shares if isinstance(shares, dict) else {"train": shares, "test": 1 - Decimal(str(shares))}
    exact = {name: Decimal(str(share)) for name, share in shares.items()}
    digits = max(2, math.ceil(math.log(max(1, rows.count()) / 10_000 + 1, 16)))
    hashed = rows.withColumn("__h", F.sha2(F.col(key).cast("string"), 256)).withColumn("__b", F.substring("__h", 1, digits))
    sizes = hashed.groupBy(F.col(label).alias("__label"), F.col("__b").alias("__bucket")).agg(F.count("*").alias("__n"))
    w = W.partitionBy("__label").orderBy(F.asc_nulls_last("__bucket"))
    before = sizes.select("__label", "__bucket", F.coalesce(F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(W.partitionBy("__label")).alias("__all"))
    ranked = hashed.withColumn("__at", F.row_number().over(W.partitionBy(label, "__b").orderBy(F.asc_nulls_last("__h"), F.asc_nulls_last(key))))
    placed = ranked.join(before, F.col(label).eqNullSafe(F.col("__label")) & F.col("__b").eqNullSafe(F.col("__bucket")))
    *names, last = exact
    part, upto = F.lit(last), sum(exact.values())
    for name, following in zip(reversed(names), reversed(list(exact)[1:]), strict=True):
        upto -= exact[following]
        part = F.when(F.col("__before") + F.col("__at") <= F.round(F.col("__all") * F.lit(upto)), name).otherwise(part)
    return placed.withColumn(out, part).drop("__h", "__b", "__at", "__label", "__bucket", "__before", "__all")


def confusion(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    return rows.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def classification_report(matrix: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per label precision, recall, f1 and support from a confusion matrix."""
    by_truth = matrix.groupBy(F.col(truth).alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0)).alias("hits"))
    by_guess = matrix.groupBy(F.col(predicted).alias("label")).agg(F.sum("n").alias("guessed"))
    both = by_truth.join(by_guess, "label", "full_outer").fillna(0)
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    p, r = ratio("hits", "guessed"), ratio("hits", "support")
    return both.select("label", p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), "support")


def overall_scores(report: DataFrame) -> DataFrame:
    """One row from a per-label report: support, accuracy, and precision, recall and f1 weighted by support."""
    n = F.sum("support")
    weighted = lambda c: F.when(n > 0, F.sum(F.col(c) * F.col("support")) / n).otherwise(0.0).alias(f"weighted_{c}")
    return report.agg(n.alias("support"), F.when(n > 0, F.sum(F.col("recall") * F.col("support")) / n).otherwise(0.0).alias("accuracy"), weighted("precision"), weighted("recall"), weighted("f1"))
