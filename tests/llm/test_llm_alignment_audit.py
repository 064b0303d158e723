"""Alignment of tokenizers, MinHash near-duplicates and the audit of filters: against brute force and on awkward rows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import filter_audit, minhash_tensor, token_alignment

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, bucket string, block long"
AWKWARD = [
    (1, None, None, None, None, 1, "x", 1), (2, "", "en", "a", 0, 1, "x", 1), (None, "no id here", "en", "a", 10, 1, "x", 1), (4, "one", "en", None, 3, 1, "x", 1),
    (5, "the same text of five words or more", "en", "b", 30, 1, "x", 1), (6, "the same text of five words or more", "en", "b", 30, 1, "x", 1), (6, "the same text of five words or more", "en", "b", 30, 1, "x", 1),
    (7, "12345 !!! ...", "fr", "b", 12, 1, "x", 1), (8, "der lange text " * 20000, "de", "b", 300000, 1, "x", 1), (9, " \n\t ", "de", "c", 4, 1, "x", 1), (10, "ONE", "", "c", 3, 1, "x", 1),
]
STRANGE = [
    "  two  spaces ", "a▁b", "ﬁne ½ Ⅳ", "family 👩‍👩‍👧 and 日本語 テスト", "<s> </s> <unk> <0x41> <|endoftext|>", "a b　c", "\x00\x01", "x" * 3000, " ", "\n", "é é", "٣٤ ४५ ǅ", "a\tb\r\nc",
    "it's we'll THEY'RE", "1234567 12.5%", "ünïcödé ßß", "\u0085 nel",
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_alignment(texts):
    """Per text (n_a, n_b, n_groups, links as id pairs, groups text), from the libraries' own encoders and plain loops."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = token_alignment.byte_alphabet()
    out = []
    for text in texts:
        want = (" " + text).encode() if text else b""
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            out.append((0, 0, 0, [], ""))
            continue
        spans = []
        for parts in (a_bytes, b_bytes):
            ends = list(itertools.accumulate(map(len, parts)))
            spans.append(list(zip([0, *ends[:-1]], ends, strict=True)))
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e] if len(a) * len(b) < 10**6 else None
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for end in shared:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, side, strict=True) if low <= s and e <= end) for ids, side in ((a, spans[0]), (b, spans[1]))))
            low = end
        out.append((len(a), len(b), len(shared), links, ";".join(groups)))
    return out


def test_alignment_matches_brute_force(spark, tiny):
    given = spark.read.parquet(f"{tiny}/documents.parquet").where("length(text) < 1500").select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    rows = [(r["doc_id"], r["text"]) for r in given] + [(10_000 + i, t) for i, t in enumerate([*STRANGE, None, "", given[0]["text"]])] + [(None, given[1]["text"])]
    want = brute_alignment([t for _, t in rows])
    counts = Counter(link for _, _, _, links, _ in want for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    expected = sorted(
        (str(i), na, nb, ng, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if na else "")
        for (i, _), (na, nb, ng, links, g) in zip(rows, want, strict=True)
    )
    got = token_alignment.align_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got.columns == token_alignment.RESULT
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == expected
    assert sum(not x[1] for x in expected) >= 3  # texts whose pieces do not give the text back


def test_blocks_do_not_change_counts(spark):
    """Many blocks against one: a partition has blocks of its own."""
    rows = spark.createDataFrame([(i, f"word{i % 7} and other words {i} " * (i % 5)) for i in range(60)], "doc_id long, text string").coalesce(1)
    whole = sorted(token_alignment.align_documents(rows).collect())
    assert sorted(token_alignment.align_documents(rows.repartition(8)).collect()) == whole


def test_alignment_of_positions(spark, awkward, none):
    got = {r["doc_id"]: r for r in token_alignment.alignments(awkward.where("doc_id in (1, 2, 4, 5, 8)")).collect()}
    assert got[1]["a_ids"] == got[2]["link_a"] == [] and got[4]["group_ends"] == [4]
    five = got[5]
    a_spans, b_spans = (list(zip([0, *five[c][:-1]], five[c], strict=True)) for c in ("a_ends", "b_ends"))
    linked = [(i, j) for i, (s, e) in enumerate(a_spans) for j, (t, f) in enumerate(b_spans) if s < f and t < e]
    assert list(zip(five["link_a"], five["link_b"], strict=True)) == linked
    assert five["group_ends"] == sorted(set(five["a_ends"]) & set(five["b_ends"])) and got[8]["a_ends"][-1] == len(" " + "der lange text " * 20000)
    assert token_alignment.alignments(none).count() == token_alignment.align_documents(none).count() == 0
    rows = token_alignment.align_documents(awkward).collect()
    assert len(rows) == len(AWKWARD) and sum(r["groups_sha256"] == "" for r in rows) == 2


def brute_sets(texts):
    low = [WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for t in texts]
    return [{" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set() for w in low]


def brute_groups(ids, sets):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(ids)):
        members.setdefault(root(i), []).append(ids[i])
    least = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return [least[root(i)] for i in range(len(ids))]


def families(seed=3, n=40):
    """Families of versions around the threshold, chains, copies, and texts that share a long passage only."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = [word() for _ in range(60)]
    texts = []
    for k in range(n):
        base = [word() for _ in range(rng.choice([4, 40, 120]))]
        texts.append(base)
        for _ in range(rng.choice([0, 1, 6])):
            base = list(base) if k % 3 else list(texts[-1])
            for _ in range(rng.choice([1, 2, 3, 4])):
                base[rng.randrange(len(base))] = word()
            texts.append(base)
        texts.append([word() for _ in range(20)] + passage)
    rows = [" ".join(t) for t in texts] + [" ".join(texts[0])] * 20 + ["a b", "a b", "A  b", "x", None, "", " \n"]
    rng.shuffle(rows)
    return rows


def test_minhash_matches_brute_force(spark):
    texts = families()
    ids = [i * 3 + 1 for i in range(len(texts))]
    sets = brute_sets(texts)
    want = brute_groups(ids, sets)
    got = {r["doc_id"]: r for r in minhash_tensor.near_duplicates(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(s), c if s else i, (c if s else i) == i) for i, s, c in zip(ids, sets, want, strict=True)}
    assert len(set(want)) < len(ids) - 40


def test_minhash_in_blocks(spark, monkeypatch):
    """Meetings larger than a block are compared block by block, with the same result."""
    texts = families(5, 12)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(minhash_tensor.near_duplicates(rows).collect())
    monkeypatch.setattr(minhash_tensor, "BLOCK_ROWS", 2)
    assert sorted(minhash_tensor.near_duplicates(rows).collect()) == whole


def test_pairs_across_labels_once_each():
    """Each pair of different labels that shares a key comes once, whatever sides and however many keys it shares."""
    import pandas as pd

    rng = np.random.default_rng(1)
    n = 60
    u, v = rng.integers(0, 4, (n, 3)), rng.integers(0, 3, (n, 4)).astype(np.int32)
    label, size = rng.integers(0, 9, n), rng.integers(90, 110, n)
    sets = [np.unique(np.concatenate((np.arange(80), rng.choice(np.arange(80, 120), m - 80, replace=False)))).astype(np.int32) for m in size]
    rows = [(i * 100 + int(u[k, i]), k, int(label[k]), 0, int(size[k]), i, u[k], v[k], sets[k]) for k in range(n) for i in range(3)]
    frame = pd.DataFrame(rows, columns=["bucket", "node", "label", "side", "size", "i", "u", "v", "w"]).sort_values("bucket")
    alike = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    want = {(a, b) for a in range(n) for b in range(a) if label[a] != label[b] and (u[a] == u[b]).any() and (v[a] == v[b]).any() and alike(a, b)}
    assert 20 < len(want) < n * n / 4
    found = pd.concat(minhash_tensor.cross_pairs(frame, 85))
    pairs = [(max(a, b), min(a, b)) for a, b in zip(found["a"], found["b"], strict=True)]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    split = frame.assign(side=frame["node"] % 2 + 1)
    between = [(max(a, b), min(a, b)) for f in minhash_tensor.cross_pairs(split, 85) for a, b in zip(f["a"], f["b"], strict=True)]
    assert len(between) == len(set(between)) and set(between) == {p for p in want if (p[0] + p[1]) % 2}


def test_minhash_recall_of_tables():
    """Sketches of sets at the threshold share a key as often as promised, and those far below hardly ever."""
    rng, family = np.random.default_rng(7), minhash_tensor.hash_family()
    lost = far = 0
    for _ in range(150):
        common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (170, 15, 15))
        x, y = (minhash_tensor.sketches(minhash_tensor.minhashes(np.unique(np.concatenate((common, s))), family)[None])[0] for s in (a, b))
        lost += not ((x == y)[:20].any() and (x == y)[20:].any())
        x, y = (minhash_tensor.sketches(minhash_tensor.minhashes(np.unique(np.concatenate((common[:60], s, t))), family)[None])[0] for s, t in ((a, rng.integers(0, 2**63, 125, dtype=np.uint64)), (b, rng.integers(0, 2**63, 125, dtype=np.uint64))))
        far += (x == y)[:20].any() and (x == y)[20:].any()
    assert lost == 0 and far < 15


def test_minhash_awkward_rows(spark, awkward, none):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_tensor.near_duplicates(awkward).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 1, None, True), (4, 1, 4, True), (10, 1, 4, False), (5, 6, 5, True), (6, 6, 5, False), (6, 6, 5, False), (7, 1, 7, True), (8, 3, 8, True), (9, 0, 9, True)], key=str)
    assert minhash_tensor.near_duplicates(none).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "a b c d")], "doc_id long, text string")
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_tensor.near_duplicates(nulls).collect()), key=str) == [(3, 3, True), (None, 3, False), (None, 3, False)]


def brute_audit(rows, labels):
    """(part, order, step) to counts, by applying every order to every row."""
    failing, good, toxic, part = [], [], [], []
    for i, text, lang in rows:
        text, words = text or "", WORD.findall(text or "")
        repeated = i is not None and any((t or "") == text and j is not None and j < i for j, t, _ in rows)
        failing.append({f for f, bad in zip("ABCDE", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), repeated), strict=True) if bad})
        good.append(any(q == 1 for j, q, _ in labels if j is not None and j == i))
        toxic.append(any(t == 1 for j, _, t in labels if j is not None and j == i))
        part.append(lang or "")
    out, removed_ever = {}, Counter()
    for p in set(part):
        mine = [k for k in range(len(rows)) if part[k] == p]
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = set()
            for step, f in enumerate(order, 1):
                now = {k for k in mine if f in failing[k]} - gone
                again = sum(f in failing[k] for k in mine if k in gone)
                gone |= now
                removed_ever[p, f] += len(now)
                out[p, order, step] = [len(mine) - len(gone), len(now), again, sum(failing[k] == {f} for k in mine), sum(good[k] for k in now), sum(toxic[k] for k in now)]
    return {k: (*v, removed_ever[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_matches_brute_force(spark, awkward, none):
    rng = random.Random(2)
    some = [" ".join(rng.choices(["alpha", "BETA", "c#", "d", "EE"] + [f"w{i}" for i in range(m)], k=n)) for n in (5, 120, 150) for m in (1, 60, 900) for _ in range(3)]
    rows = [(i, rng.choice(some), rng.choice(["en", "de", None, ""])) for i in range(60)] + [(3, some[0], "en"), (None, some[0], "en"), (None, some[1], "fr"), *((r[0], r[1], r[2]) for r in AWKWARD)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("mask", F.lit(1)).withColumn("quality", F.lit(9))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(docs, marks).collect()}
    assert got == brute_audit(rows, labels)
    assert filter_audit.audit(none, marks).count() == 0
    unlabelled = filter_audit.audit(awkward, marks.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(unlabelled) == (0, 0)


def test_audit_of_other_filters(spark):
    """Two filters of the caller's and repeated texts: six orders."""
    docs = spark.createDataFrame([(1, "a", "x"), (2, "bb", "x"), (3, "a", "x"), (4, "ab", "x")], "doc_id long, text string, kind string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(docs, marks, "kind", lambda t: {"S": F.length(t) < 2, "B": F.contains(t, F.lit("b"))}).collect()
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in rows}
    assert len(rows) == 18 and got["SBE", 1] == (2, 2, 0, 1, 9)
    assert got["SBE", 3][:4] == (0, 0, 1, 0)
    assert got["ESB", 1][:3] == (3, 1, 0) and got["ESB", 2][:3] == (2, 1, 1)
