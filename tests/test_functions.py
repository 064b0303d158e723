"""Column functions against hand-made cases."""

import html
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import greek_prep, latex, names, ocr_text, text, urls, values
from corpusloom.functions.noise import noise_metrics


def column(spark, cells, build, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_stems(spark):
    cases = {"a/paper1.per_page.metrics.json": "paper1", "x.md.pdf": "x", "X.PDF": "X.PDF", ".pdf": ".pdf", "b.docling.json.zst": "b", "c.latex_map.jsonl": "c", "plain": "plain"}
    assert column(spark, list(cases), names.canonical_stem) == list(cases.values())


def test_chunk_names(spark):
    assert column(spark, ["a__p0001-0200", "a__p0001-0200.md", "a__p1-2", "a"], names.without_chunk) == ["a", "a.md", "a__p1-2", "a"]
    assert [r["start"] for r in column(spark, ["a__p0201-0400", "x"], names.chunk_range)] == [201, 2**31 - 1]


def test_generated_names(spark):
    cases = {0: "AAA_000", 1: "AAB_001", 26: "ABA_026", 676: "BAA_676", 1000: "BMM_000"}
    assert column(spark, list(cases), names.generated_name, "long") == list(cases.values())


def test_urls(spark):
    assert column(spark, ["http://A.com//x//y/?b=2&a=1#f", "", None, "a.com/x", "  "], urls.canonical_url) == ["http://a.com/x/y/?a=1&b=2", "", "", "https://a.com/x", ""]
    assert column(spark, ["http://U:P@A.com:80/x", "a.com", "", None], urls.base_domain) == ["http://u:p@a.com:80", "https://a.com", "", ""]
    assert column(spark, ["http://a.com/x.PDF?y=z.md", "http://a.com/.hidden", "http://a.com", "http://a.com/a.tar.gz"], urls.url_extension) == ["pdf", "bin", "bin", "gz"]


def test_links(spark):
    cells = ['["u1","u2"]', '{"href":"h"}', '[{"url":"a"},{"link":"b"}]', "http://a; http://b", "http://a, http://b.", "one", "", None, "[broken"]
    assert column(spark, cells, urls.links_of) == [["u1", "u2"], ["h"], ["a", "b"], ["http://a", "http://b"], ["http://a", "http://b"], ["one"], [], [], ["[broken"]]


def test_inferred_extension(spark):
    rows = spark.createDataFrame(
        [("http://a/x", "attachment; filename*=UTF-8''r%C3%A9.docx", None, None), ("http://a/x", None, "text/html; charset=x", None), ("http://a/x.zip", None, None, b"%PDF-1.7"), ("http://a/x.zip", None, None, b"PK.. word/doc"), ("http://a/x.zip", None, None, b"?")],
        "u string, d string, t string, h binary",
    )
    assert [r[0] for r in rows.select(urls.inferred_extension(*map(F.col, "udth"))).collect()] == ["docx", "html", "pdf", "docx", "zip"]


def test_coercions(spark):
    words = ["true", " T ", "No", "", "maybe", None, "1", "na"]
    assert column(spark, words, values.strict_bool) == [True, True, False, None, None, None, True, None]
    assert column(spark, words, values.loose_bool) == [True, True, False, None, True, None, True, None]
    assert spark.sql("select 0.0d x union all select 2.0d union all select double('nan')").select(values.loose_bool(F.col("x"))).collect() == [(False,), (True,), (None,)]
    marks = ["success", "OK", " complete", "partial", "chunked", "skipped", "error", "done", "extracted", "true", None]
    assert column(spark, marks, values.outcome) == ["success"] * 5 + ["failure"] * 2 + [None] * 4
    assert column(spark, ["1.5", "NaN", " ", "x", None], values.as_float) == [1.5, None, None, None, None]
    assert column(spark, ["", "a", "a,b", None], lambda c: values.add_stage(c, "b")) == ["b", "a,b", "a,b", "b"]


@pytest.mark.parametrize(
    ("text", "field", "want"),
    [
        ("ααααβ", "v_pen", 1), ("αααα β", "v_pen", 0), ("αααα", "v_pen", 1), ("αααα\n", "v_pen", 0), ("ααα", "bad_double", 2), ("λλ", "bad_double", 0), ("ΛΛ", "bad_double", 1), ("λόγοσ λόγος", "misplaced_sigma", 1),
        ("κξ ΚΞ γβ", "invalid_bigram", 3), ("α" * 25, "long_word_count", 1), ("", "score", 0.0), ("| α | β |", "len_greek", 0), ("αάαα", "max_run", 4),
    ],
)
def test_noise(spark, text, field, want):
    row = noise_metrics(spark.createDataFrame([(text,)], "text string")).first()
    assert row[field] == want


def test_short_word_excess(spark):
    text = " ".join(["αβ"] * 30 + ["αβγδε" * 4] * 47)
    row = noise_metrics(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["len_greek"], row["short_word_count"], row["short_excess_per_1000"]) == (1000, 30, 4.0)


def test_latex(spark):
    cut = column(spark, ["x " * 59 + "x", "a b", "y" * 3500, "w " * 2 + "\\a" * 2000], latex.sanitized)
    assert (cut[0]["latex"], cut[0]["truncated_by_repeat"], cut[0]["tail_run"]) == (" ".join(["x"] * 12), True, 60)
    assert cut[1]["latex"] == "a b" and not cut[1]["truncated_by_length"]
    assert len(cut[2]["latex"]) == 3000 and len(cut[3]["latex"]) <= 3000
    (long_tail,) = column(spark, ["y" * 3500 + " x" * 20], latex.sanitized)  # the length alone opens the gate; then a tail of 20 is cut to 12
    assert (long_tail["truncated_by_repeat"], long_tail["truncated_by_length"], long_tail["latex"]) == (True, True, "y" * 3000)
    assert column(spark, [30, 100, 500, 900], latex.crop_dpi, "int") == [280, 240, 220, 180]
    assert column(spark, [30, 900], lambda c: latex.crop_dpi(c, base=300), "int") == [320, 260]


def test_greek_sentences(spark):
    texts = ["(1) α) πρώτο\tκείμενο 2. και", "IV. λόγος & έργο&πράξη /12/ {3} [τέλος] — <x>", "a&b &c d& XX) (β) γ' στ. δ"]
    assert column(spark, texts, greek_prep.cleaned_sentence) == ["πρώτο κείμενο  και", "λόγος & έργοπράξη   τέλος  x", "ab c d     δ"]
    assert column(spark, [0, 1, 2, 3, 4, 5], greek_prep.merged_label, "int") == [0, 1, 2, 3, 1, 0]
    assert column(spark, ["{a}", "}{", "\\includegraphics", "{", "x" * 6001, None], latex.accept_score) == [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_early_stop(spark):
    got = column(spark, ["same\n" * 11 + "end", "same\n" * 10 + "end", "a" * 300 + "\nb", "ok", None], ocr_text.early_stop)
    assert got == ["\n".join(["same"] * 10), "same\n" * 10 + "end", "a" * 200, "ok", None]


def test_tables_and_markdown(spark):
    page = "<table><tr><td>n/a</td><td> — </td></tr></table><table><tr><td>x</td><td>--</td></tr></table>"
    assert column(spark, [page, "plain", None], ocr_text.tables_tidied) == ["<table><tr><td>x</td><td></td></tr></table>", "plain", None]
    texts = ["exam-\nple  \n\n\n\nend<sup>3</sup> of<sup>12a</sup>", "EX-\nAM&NBSP;\xa0x<sup>[12]</sup>"]
    assert column(spark, texts, ocr_text.canonical_markdown) == ["example\n\nend<sup>3</sup> of[^12a]", "EXAM x<sup>[12]</sup>"]
    texts = ["<|User|>Hi<｜det｜>\n\n\n\n<center>x</center>", "a<|some left over|>b\n any_label[[1, 2]] c\n[[3]] d", "<table><th>&nbsp;</th><td>&ndash;</td></table>e"]
    assert column(spark, texts, ocr_text.cleaned_output) == ["Hi\n\nx", "ab\nc\n[[3]] d", "e"]
    assert column(spark, ["<td>&nbsp;N/A </td>", "<b>n/</b> a", "x", "&mdash;"], ocr_text.is_placeholder) == [True, True, False, True]
    assert column(spark, ["Say it. Say it. now"], lambda c: ocr_text.without_echo(c, "Say it.\n<image>")) == ["now"]
    assert column(spark, ["é​"], ocr_text.normalized) == ["é"]


def test_sentences(spark):
    assert column(spark, ["", "α β γ", "α β γ δ", "only latin words here now", "1 2 3 4 5 6"], greek_prep.usable) == [0, 0, 1, 0, 0]
    assert column(spark, ["1. α [σημ.] β&γ", "XIV. α"], greek_prep.cleaned_sentence) == ["α σημ. βγ", "α"]


def test_character_references(spark):
    """As Python's own decoding of HTML has them."""
    texts = [
        "a &amp; b &#8212; &#x2013; &copy;", "&notit; &not &ampx &AMP &nosuch; &", "&#128; &#x81; &#0; &#xD800; &#1114112; &#99999999999999999999; &#x1; &#13; &#xFFFE; &#x1FFFF; &#xFDD0; &#x1F600;",
        "&fjlig;&NotEqualTilde;", "no reference", "", "&&amp;;&lt;td&gt;&#60", "&#x;&#;&#xg", "&" + "a" * 40 + ";", "&CounterClockwiseContourIntegral;", "&acE;&aacute&eacutex", None, "&#0000065;&#X41",
    ]
    assert column(spark, texts, ocr_text.references_decoded) == [None if t is None else html.unescape(t) for t in texts]
    assert column(spark, ["&#8212;", "&#x2013; ", "&nbsp;&#160;", "&copy;", "<td>&#45;</td>"], ocr_text.is_placeholder) == [True, True, True, False, True]


def test_normalized_by_slices(spark):
    """Texts of several slices, nulls among them, come back in order; zero-width characters go before composing."""
    big = "é​ " * 200_000
    texts = [None, "", big, "plain", None, big, "e‍́", "Å"]
    assert column(spark, texts, ocr_text.normalized) == [None if t is None else unicodedata.normalize("NFC", t.replace("​", "").replace("‍", "")) for t in texts]


def test_values_are_worked_out_once(spark):
    """A text goes through each pattern once, however often the steps behind name it, and strip takes every white space."""
    plan = spark.createDataFrame([("x",)], "x string").select(ocr_text.cleaned_output(F.col("x")).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("tikzpicture") == 3  # once in the search, twice in the pattern
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
    assert column(spark, ["".join(blanks) + "a b" + "".join(blanks), "", None, "​ a"], text.strip) == ["a b", "", None, "​ a"]
