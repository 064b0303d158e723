"""Each operator against a brute-force version or held-out rows, and on awkward rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import fingerprint_cws, language_id, maxscore, packing, pii_surrogates, simhash_dedup, site_style, source_mix, toxicity, url_rules

KEY = "a test key"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, host string, bucket string"
AWKWARD = [
    (1, None, None, None, None, 1, "x", "y"), (2, "", "en", "a", 0, 1, "x", "y"), (None, "no id here", "en", "a", 10, 1, "x", "y"), (4, "one", "en", None, 3, 1, "x", "y"),
    (5, "the same text of five words or more", "en", "b", 30, 1, "x", "y"), (6, "the same text of five words or more", "en", "b", 30, 1, "x", "y"), (6, "the same text of five words or more", "en", "b", 30, 1, "x", "y"),
    (7, "12345 !!! ...", "fr", "b", 12, 1, "x", "y"), (8, "der lange text " * 20000, "de", "b", 300000, 1, "x", "y"), (9, " \n\t ", "de", "c", 4, 1, "x", "y"),
]


@pytest.fixture(scope="module")
def docs(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet").cache()


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def brute_simhash(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, max_bits):
    ids, parent = list(range(len(fingerprints))), list(range(len(fingerprints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids[:i]:
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in ids]


def test_simhash_matches_brute_force(docs):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash_dedup.near_duplicates(docs).collect()}
    fps = [brute_simhash(r["text"]) for r in rows]
    roots = brute_components(fps, 3)
    least = defaultdict(list)
    for r, k in zip(rows, roots, strict=True):
        least[k].append(r["doc_id"])
    assert got == {r["doc_id"]: (f, min(least[k])) for r, f, k in zip(rows, fps, roots, strict=True)}


def test_every_near_pair_shares_a_mask():
    rng = np.random.default_rng(1)
    masks = simhash_dedup.exact_masks()
    for _ in range(500):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, 3, replace=False):
            y ^= 1 << int(b)
        assert any(x & m == y & m for m in masks)


def test_links_of_dense_and_split_buckets(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 2**62))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (150, 2))} | {int(x) for x in rng.integers(0, 2**62, 50)})
    monkeypatch.setattr(simhash_dedup, "BLOCK_ROWS", 16)
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = [(r["a"], r["b"]) for r in simhash_dedup.link_fingerprints(distinct, simhash_dedup.exact_masks()).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    where = {f: i for i, f in enumerate(fps)}
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(where[a])] = root(where[b])
    mine, want = [root(i) for i in range(len(fps))], brute_components(fps, 3)
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1, 1) for i in range(40)], "a long, b long, apart int")
    nodes = spark.createDataFrame([(i, 100 - i) for i in range(41)], "fp long, least long")
    assert {r["least"] for r in simhash_dedup.components(links, nodes).collect()} == {60}


def test_similar_documents_finds_edited_copies(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    base = [[words[i] for i in rng.integers(0, 3000, 300)] for _ in range(40)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i, b in enumerate(base[:20]):
        edited = list(b)
        for at in (50, 150, 250):
            edited[at] = "changed"
        rows.append((100 + i, " ".join(edited)))
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[100 + i] == i for i in range(20)) >= 19
    assert all(got[i] == i for i in range(40))


def changed_words(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return out


def brute_similar(texts, fps):
    """Groups of positions by brute force: Jaccard of at least 0.8 on five-word shingles, or equal fingerprints."""
    sets = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    jaccards = []
    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            jaccards.append(common / (len(sets[i]) + len(sets[j]) - common))
            if jaccards[-1] >= 0.8 or fps[i] == fps[j]:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], jaccards


def similar_against_brute_force(spark, texts):
    rows = simhash_dedup.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    want, jaccards = brute_similar(texts, [r["fp"] for r in rows])
    assert [r["component_id"] for r in rows] == want
    return jaccards


def test_similar_documents_near_the_threshold(spark):
    rng = np.random.default_rng(12)
    texts = []
    for _ in range(80):
        base = [f"w{i}" for i in rng.integers(0, 3000, 200)]
        texts += [" ".join(base), " ".join(changed_words(rng, base, int(rng.integers(3, 6))))]
    jaccards = similar_against_brute_force(spark, texts)
    assert sum(0.8 <= x <= 0.85 for x in jaccards) >= 20 and sum(0.75 <= x < 0.8 for x in jaccards) >= 10


def test_similar_documents_where_the_closest_pairs_fail(spark):
    rng = np.random.default_rng(13)
    texts = []
    while len(texts) < 24:
        base = [f"w{i}" for i in rng.integers(0, 3000, 100)]
        trio = [" ".join(x) for x in (base, changed_words(rng, base, 2), changed_words(rng, base, 3))]
        a, b, c = (simhash_dedup.fingerprint_of(x, 5) for x in trio)
        if max((a ^ c).bit_count(), (b ^ c).bit_count()) < (a ^ b).bit_count() <= 8 and a != c != b:
            texts += trio
    similar_against_brute_force(spark, texts)


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer_path())
    rows = packing.pack(packing.pieces(docs)).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc, piece in rows.groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        piece = piece.sort_values("piece")
        assert piece["piece"].tolist() == list(range(len(piece)))
        assert piece["start"].tolist() == list(range(0, len(ids), 4096))
        assert piece["ids_crc32"].tolist() == [zlib.crc32(ids[s : s + 4096].tobytes()) for s in range(0, len(ids), 4096)]
        assert piece["length"].sum() == len(ids)
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]]
        assert seq["length"].sum() <= 4096
    assert rows["sequence_id"].nunique() <= -(-rows["length"].sum() // 4096) + 2


def test_word_ids_equal_whole_text_ids():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer_path()
    texts = ["Été  naïve\tΣΊΣΥΦΟΣ\r\nCafé  x y 123 don't!!", "", " ", "a" * 3000, "😀👍🏽 <b>x</b>", "İstanbul ẞ ​ ﬁ"]
    whole = Tokenizer.from_file(path)
    assert [x.tolist() for x in packing.WordIds(path)(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_local_search_empties_bins():
    lengths = [70, 50, 30, 30, 20]
    bins = packing.local_search([[0, 4], [1], [2, 3]], lengths, 100)
    assert sorted(sorted(lengths[i] for i in b) for b in bins) == [[20, 30, 50], [30, 70]]
    rng = np.random.default_rng(8)
    lengths = rng.integers(1, 900, 300).tolist()
    before = [[i] for i in range(300)]
    after = packing.local_search(before, lengths, 1000)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 1000 for b in after) and len(after) < 200


def brute_cws(a, b, samples=4000, seed=5):
    """The collision rate of consistent weighted samples drawn for the words themselves."""
    rng = np.random.default_rng(seed)
    words = sorted(set(a) | set(b))
    hits = 0
    for _ in range(samples):
        r, c, u = rng.gamma(2, 1, len(words)), rng.gamma(2, 1, len(words)), rng.random(len(words))
        picks = []
        for bag in (a, b):
            best = None
            for k, w in enumerate(words):
                if bag.get(w):
                    t = np.floor(np.log(bag[w]) / r[k] + u[k])
                    value = (c[k] * np.exp(-r[k] * (t - u[k]) - r[k]), w, t)
                    best = min(best, value) if best else value
            picks.append(best[1:])
        hits += picks[0] == picks[1]
    return hits / samples


def test_signature_collisions_follow_generalised_jaccard():
    rng = np.random.default_rng(4)
    deltas = []
    for _ in range(30):
        a = Counter(f"w{i}" for i in rng.integers(0, 60, 200))
        b = Counter(a)
        for i in rng.integers(0, 60, 40):
            b[f"w{i}"] += 2
        jaccard = sum(min(a[w], b[w]) for w in a | b) / sum(max(a[w], b[w]) for w in a | b)
        text = lambda bag: " ".join(w for w, n in bag.items() for _ in range(n))
        deltas.append(fingerprint_cws.likeness(fingerprint_cws.signature(text(a)), fingerprint_cws.signature(text(b))) - jaccard)
    assert abs(np.mean(deltas)) < 0.03
    small_a, small_b = {"x": 3, "y": 1}, {"x": 1, "y": 2, "z": 1}
    assert abs(brute_cws(small_a, small_b) - 2 / 6) < 0.03


def test_variates_are_gamma_and_uniform():
    words = np.random.default_rng(6).integers(0, 2**63, 800, dtype=np.uint64)
    first = fingerprint_cws.hashes(words, 0)
    r, b, start = (v.ravel() for v in fingerprint_cws.variates(words, first))
    c = np.exp(start + r - r * b)
    grid = np.linspace(0.2, 8, 40)
    for v in (r, c):
        assert np.abs([(v <= x).mean() - (1 - np.exp(-x) * (1 + x)) for x in grid]).max() < 0.01
    assert np.abs([(b <= x).mean() - x for x in np.linspace(0, 1, 21)]).max() < 0.01
    assert np.abs(np.corrcoef([r, b, c]) - np.eye(3)).max() < 0.02
    by_sample = first.astype(np.float64)
    assert np.abs(np.corrcoef(by_sample.T) - np.eye(fingerprint_cws.SAMPLES)).max() < 0.2


def test_signature_is_the_least_value_by_definition():
    """Every sample is the word and t of the least c * exp(r b - r t - r), computed word by word."""
    bag = Counter({f"w{i}": 1 + i % 4 for i in range(60)}) + Counter({"often": 500})
    got = fingerprint_cws.signature(" ".join(w for w, n in bag.items() for _ in range(n)))
    best = [(np.inf, None)] * fingerprint_cws.SAMPLES
    for w, n in bag.items():
        word = np.array([xxhash.xxh64_intdigest(w.encode(), fingerprint_cws.SEED)], np.uint64)
        first = fingerprint_cws.hashes(word, 0)
        r, b, start = (v[0] for v in fingerprint_cws.variates(word, first))
        c = np.exp(start + r - r * b)
        t = np.floor(np.log(n) / r + b)
        value = c * np.exp(r * b - r * t - r)
        for k in range(fingerprint_cws.SAMPLES):
            mixed = ((int(first[0, k]) ^ int(t[k])) * 0xBF58476D1CE4E5B9 % 2**64) >> 48
            best[k] = min(best[k], (value[k], int(first[0, k]) & 0xFFFF if t[k] == 0 else mixed))
    assert (got == np.array([code for _, code in best])).mean() > 0.99


def test_unrelated_texts_of_many_words_do_not_look_alike():
    for n in (2000, 20_000, 90_000):
        a, b = (fingerprint_cws.signature(" ".join(f"{x}{i}" for i in range(n))) for x in "ab")
        assert fingerprint_cws.likeness(a, b) < 0.01
    again = fingerprint_cws.signature(" ".join(f"a{i}" for i in reversed(range(90_000))))
    assert (fingerprint_cws.signature(" ".join(f"a{i}" for i in range(90_000))) == again).all()
    left, right = "one two three two " * 50, "one two three two " * 40 + "four five " * 30
    both = fingerprint_cws.signatures(left, right, 700)
    assert all((x == fingerprint_cws.signature(t)).all() for x, t in zip(both, (left, right), strict=True))


def test_fingerprints_match_brute_force(docs):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    got = {r["doc_id"]: r for r in fingerprint_cws.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        sig, other, following = map(fingerprint_cws.signature, (text, changed, after))
        r = got[doc]
        import hashlib

        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r["fingerprint"] == fingerprint_cws._bytes(sig).hex()
        assert r["near_edited"] == pytest.approx(fingerprint_cws.likeness(sig, other))
        assert r["near_next"] == pytest.approx(fingerprint_cws.likeness(sig, following))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_language_pairs_inside_a_family():
    assert language_id.family_of("pt-BR") == "romance"
    assert language_id.family_of("qq") == "other"


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.judge(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = got[got["toxic"] == 1]["score"], got[got["toxic"] == 0]["score"]
    assert np.mean([(toxic > c).mean() + 0.5 * (toxic == c).mean() for c in clean.sample(200, random_state=1)]) > 0.9
    assert (got[got["toxic"] == 0]["predicted"] == 1).mean() < 0.03


def test_toxicity_of_few_labels(spark):
    clean = [(i, f"the river runs past village number {i} and the mill on its bank") for i in range(54)]
    toxic = [(100 + i, f"you are a stupid idiot and worthless scum, you pathetic loser {i}") for i in range(6)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in clean + toxic], "doc_id long, toxic int")
    got = toxicity.Model(docs, labels, folds=1, fold=1).score(docs).collect()
    assert min(r["__tox_score"] for r in got if r["doc_id"] >= 100) >= 0.7 > max(r["__tox_score"] for r in got if r["doc_id"] < 100)
    three = labels.where("toxic = 0 or doc_id < 103")
    uncalibrated = toxicity.Model(docs, three, folds=1, fold=1)
    assert uncalibrated.calibration is None and uncalibrated.trees is not None
    repeated = docs.union(docs.where("doc_id = 100")).union(docs.where("doc_id = 100"))
    assert toxicity.labelled_sample(repeated, labels, 1, 1).count() == 60


def test_obfuscated_insults_count():
    tokens = toxicity.TokenKinds({})
    plain, hidden = (toxicity.text_features(t, tokens) for t in ("you are an idiot now", "you are an 1d!0t now"))
    assert plain[0] == hidden[0] > 0
    assert hidden[11] > plain[11]


PAGE = "<html><body><nav><a href='/'>Home</a></nav><div class='x'>{same}</div><div class='content'><h1>T{n}</h1><p>Text {n} is <b>here</b>&amp;there.<p>And\n more {n}</div><footer>f</footer><script>var p='</p>'</script></body></html>"


def test_style_tree_removes_what_repeats(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format(n=i, same="Buy now, all of you")) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"T{i}\nText {i} is here&there.\nAnd more {i}" for i in range(40)}


def test_style_tree_on_small_hosts_and_inside_articles(spark):
    """Hosts of a dozen pages: what repeats goes inside articles too; copied articles and lone ones stay whole."""
    rows, want = [], {}
    for host in range(5):
        for i in range(12):
            body = f"<p>story {host} {i} first.</p><p>story {host} {i} second, which goes on.</p>"
            share, strip = f"<div class='x1'>Tell friends of site {host}</div>", f"<div class='x2'><p>All about site {host}</p></div>"
            text = f"story {host} {i} first.\nstory {host} {i} second, which goes on."
            page = f"<body><div>{strip}<article><h1>Title {host} {i}</h1>{body}{share}</article></div></body>" if host < 3 else f"<body><div>{strip}<div class='c'>{body}</div>{share}</div></body>"
            rows.append((len(rows), f"http://h{host}.example/{i}", page))
            want[len(rows) - 1] = (f"Title {host} {i}\n" if host < 3 else "") + text
    for i in range(12):  # one article, copied all over a host
        rows.append((len(rows), f"http://copies.example/{i}", "<body><article><h1>One title</h1><p>The same text.</p><p>And more of it.</p></article></body>"))
        want[len(rows) - 1] = "One title\nThe same text.\nAnd more of it."
    got = {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_surrogates_leave_nothing_of_a_name_and_no_more(spark):
    """Names of several parts, phones of any grouping, IPv6, ordinary words, persons and addresses, check digits."""
    texts = [
        "Dr Anna Maria Schmidt called. Schmidt left.", "John F. Kennedy and Maria de la Cruz met Hans-Peter Müller.", "Call +49 30 123456 or +442071838750 now.", "host 2001:db8:85a3::8a2e:370:7334 and fe80::1 at 12:30:45 in std::vector and a::b",
        "Mr May came in May. May I ask Mr Will? Will you?", "Mr Jon Smith wrote. jon.smith@example.com answered.", "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "Mr Stone threw a stone. Stone walls. Mr Reader is a reader. Reader!",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["text"] for r in pii_surrogates.replace(rows, KEY).orderBy("doc_id").collect()]
    assert not re.search("Anna|Maria|Schmidt", got[0]) and re.fullmatch(r"Dr \w+ \w+ (\w+) called\. \1 left\.", got[0])
    assert re.fullmatch(r"\w+ [A-Z]\. \w+ and \w+ de la \w+ met \w+-\w+ \w+\.", got[1]) and not re.search("Kennedy|Cruz|Hans|Müller", got[1])
    assert re.fullmatch(r"Call \+49 \d\d \d{6} or \+44\d{10} now\.", got[2]) and "123456" not in got[2] and "2071838750" not in got[2]
    assert re.fullmatch(r"host [0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4} and [0-9a-f]{4}::[0-9a-f] at 12:30:45 in std::vector and a::b", got[3]) and "fe80" not in got[3]
    assert re.fullmatch(r"Mr (?!May)\w+ came in May\. May I ask Mr (?!Will)\w+\? Will you\?", got[4])
    first, last = re.fullmatch(r"Mr (\w+) (\w+) wrote\. \w+\.\w+@\w+\.com answered\.", got[5]).groups()
    assert f"{first.lower()}.{last.lower()}@" in got[5] and (first, last) != ("Jon", "Smith")
    for account in re.findall(r"[A-Z]{2}\d\d[ A-Z0-9]*\d", got[6]):
        turned = (account[4:] + account[:4]).replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 and account not in texts[6]
    assert re.fullmatch(r"Mr (?!Stone)\w+ threw a stone\. Stone walls\. Mr (?!Reader)\w+ is a reader\. Reader!", got[7])


def main_texts(spark, rows):
    return {r["page_id"]: r["text"] for r in site_style.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_style_tree_tells_places_apart(spark):
    """Blocks of one element name are judged by their place; small hosts and copies lose nothing."""
    story = lambda i: f"The {i}th story is about {'the sea and its ships ' * (i % 3 + 2)}number {i}."
    share = "<p>Share this story with all of your friends today.</p>"
    rows = [(i, f"http://food.org/{i}", f"<html><body><article><p>{story(i)}</p><h2>Ingredients</h2>{share}</article></body></html>") for i in range(6)]
    rows += [(10 + i, f"http://two.org/{i}", f"<html><body><article>teaser {i}</article><div><p>The long story: {story(i)}</p></div></body></html>") for i in range(2)]
    rows += [(20 + i, f"http://same.org/{i}", f"<html><body><div><p>{story(1)}</p></div></body></html>") for i in range(9)]
    got = main_texts(spark, rows)
    assert all(got[i] == f"{story(i)}\nIngredients" for i in range(6))
    assert all(got[10 + i] == f"teaser {i}\nThe long story: {story(i)}" for i in range(2))
    assert all(got[20 + i] == story(1) for i in range(9))


def test_style_tree_cleans_a_site_without_telling_names(spark):
    """Nothing but the tree tells this site's menu, notice and copyright from its texts."""
    words = "sea ship port wind sail rope mast deck crew tide".split()
    text = lambda i, k: " ".join(words[(i * 7 + k * 3 + j * (i + 1)) % 10] for j in range(9)) + f" {i} {k}"
    page = lambda i: (
        "<html><body><div class='x1'><p><a href='/'>Home</a> <a href='/a'>All texts</a></p><p>Welcome to our pages</p></div>"
        + f"<div class='q7'><h1>Title {i}</h1>" + "".join(f"<p>{text(i, k)}</p>" for k in range(2 + i % 3)) + "</div><div class='z3'><p>All rights reserved by the owners of these pages</p></div></body></html>"
    )
    rows = [(i, f"http://plain.org/{i}", page(i)) for i in range(12)]
    got = main_texts(spark, rows)
    assert got == {i: "\n".join([f"Title {i}", *(text(i, k) for k in range(2 + i % 3))]) for i in range(12)}
    assert all("Home All texts" in site_style.extract(h, set()) and "rights" in site_style.extract(h, set()) for _, _, h in rows)


def test_names_of_classes_alone_remove_no_content():
    cases = {
        '<div id="page" class="has-sidebar"><p>Story</p></div>': "Story", '<article class="post no-comments"><p>Story</p></article>': "Story",
        '<article><p>Story</p><div class="search-party">Found them</div></article>': "Story\nFound them",
        "<div><p>The long story that stands outside of the teaser.</p><article><p>teaser</p></article></div>": "The long story that stands outside of the teaser.\nteaser",
        '<div class="content sidebar"><article><p>Story</p></article></div>': "Story", '<p>Story</p><div class="ad">Buy</div><ul class="comment-list"><li>me too</li></ul><div id="cookieNotice">ok</div>': "Story",
        "<article>One<article>Two</article>Three</article>": "One\nTwo\nThree",
    }
    assert {page: site_style.extract(page, set()) for page in cases} == cases


def test_articles_equal_their_source(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in site_style.main_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", raw[r["page_id"]], re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_top_k_on_awkward_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, [0.5] * 8), (405, [0.5] * 8), (None, [0.1] * 8), (420, [1000.0] * 8)]
    got = defaultdict(list)
    for r in maxscore.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    whole = {i: np.floor(64 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:20]
        assert got[q] == [(i, -s) for s, i in scores]
    assert len(got) == sum(i % 20 == 0 for i in whole)


def test_targets_by_filling(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, None: 500}
    rows = [(s, n) for s, n in sizes.items()]
    got = {r["source"]: r["target"] for r in source_mix.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weights = dict(zip(["a", "b", "c", None], (5, 2, 1, 5), strict=True))
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ -= over
    want |= {s: level * weights[s] for s in open_}
    assert got == pytest.approx(want)


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(9)
    rows = [(f"s{i:02}", int(n)) for i, n in enumerate(rng.integers(1, 1000, 40))]
    got = source_mix.source_targets(spark.createDataFrame(rows, "source string, size long")).toPandas().sort_values("source")
    assert got["target"].sum() == pytest.approx(1.5 * got["source_size"].sum())
    assert (got["target"] <= 2 * got["source_size"] + 1e-9).all() and (got["target"] > 0).all()
    free = got[got["target"] < 2 * got["source_size"] - 1e-6]
    level = free["target"] / np.array([5, 2, 1])[free.index.map(lambda i: int(got.loc[i, "source"][1:]) % 3)]
    assert level.max() == pytest.approx(level.min())


def test_mix_comes_near_its_targets(docs):
    rows = source_mix.mix(docs).toPandas()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), largest=("size", "max"))
    assert ((by["taken"] - by["target"]).abs() <= 2 * by["largest"]).all()
    assert (rows["taken"] <= 2 * rows["size"]).all() and (rows["taken"] >= 0).all()
    assert by["target"].sum() == pytest.approx(1.5 * rows["size"].sum())


def test_url_rules(spark):
    urls = {
        "http://a.example.net/en/1": ("example.net/en/", "allow"), "http://example.net/de/": ("net/", "block"), "https://x.example.com/de/9": ("example.com/de/", "block"),
        "http://x.org/fr/": ("org/fr/", "allow"), "http://notexample.com/de/": (None, "allow"), "http://m.ads-track.example.com/en/": (None, "block"), "http://a.net": (None, "allow"), "no scheme": (None, "allow"), None: (None, "allow"),
    }
    rows = list(urls)
    got = url_rules.judge(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")).collect()
    assert {rows[r["page_id"]]: (r["rule"], r["verdict"]) for r in got} == urls


def test_rarest_token_is_the_key(spark):
    subjects = spark.createDataFrame([("a.example.net\n/en/",), ("b.example.com\n/en/",), ("c.net\n/",)], "subject string")
    assert url_rules.rarest_tokens(subjects, [url_rules.site_rule("example.net", "/en/", "allow")]) == {"example.net/en/": "example"}


def test_surrogates(spark):
    texts = [
        (1, "write to Jane.Doe@mail.example.com or jane.doe@mail.example.com from 10.0.200.7, call +1 (555) 123-4567"), (2, "card 4111111111111111 and Mrs Maria Lopez met Mr John Smith; password=e49acfe9789f5d7d77"),
        (3, "again Jane.Doe@mail.example.com"), (4, "version 1.2.3 of 2024, chapter 12"), (5, None), (6, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii_surrogates.replace(docs, KEY).collect()}
    assert (got[4], got[5], got[6]) == (texts[3][1], None, "")
    first, second = re.findall(r"\S+@\S+", got[1])
    assert first.rstrip(",").lower() == second.rstrip(",").lower() and first != "Jane.Doe@mail.example.com"
    assert re.search(r"\S+@\S+", got[3])[0] == first
    card = re.search(r"\d{16}", got[2])[0]
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0
    names = pii_surrogates.GIVEN_NAMES
    assert re.search(r"Mrs (\w+)", got[2])[1] in names["latin female"].split() and re.search(r"Mr (\w+)", got[2])[1] in names["latin male"].split()
    for gone in ("4111111111111111", "Maria", "Lopez", "Smith", "e49acfe9789f5d7d77", "123-4567", "10.0.200.7"):
        assert gone not in " ".join(t for t in got.values() if t)
    assert [len(t) for t in (got[2], got[3])] == [len(texts[1][1]) + len(got[2]) - len(texts[1][1]), len(texts[2][1])]


def test_surrogates_are_one_to_one(spark):
    every = spark.range(0, 10000).select(F.format_string("555-%02d-%04d", (F.col("id") / 100).cast("int"), F.col("id") % 100).alias("e"))
    got = every.select("e", pii_surrogates.surrogate(F.col("e"), KEY).alias("s"))
    assert got.select("s").distinct().count() == 10000
    assert got.where("e = s").count() == 0


def test_many_names_stay_distinct(spark):
    """100,000 surnames, the listed names in three cases, and secrets of every kind: no collision, no fixed point."""
    syllables = F.array(*[F.lit(a + b) for a in "bdfklmnprst" for b in "aeiou"])
    at = lambda k: F.element_at(syllables, (F.pmod(F.floor(F.col("id") / 55**k), F.lit(55)) + 1).cast("int"))
    name = F.concat(F.initcap(at(0)), at(1), F.when(F.col("id") >= 3025, at(2)).otherwise(F.lit("")))
    names = spark.range(100_000).select(F.concat(F.lit("Mr "), name).alias("text"))
    listed = [f"Mr {form(n)}" for pool in pii_surrogates.GIVEN_NAMES.values() for n in pool.split() for form in (str, str.upper, str.lower)]
    secrets = [f"password={x}" for x in ("1a2b3c", "abc12z", "1234567", "7654321", "deadbeef1", "12345z", "12345u", "a1b2c3")]
    docs = names.union(spark.createDataFrame([(x,) for x in listed + secrets], "text string"))
    assert pii_surrogates.collisions(docs, KEY).count() == 0
    kind = lambda c: F.when(F.rlike(c, F.lit("=[0-9]+$")), 0).when(F.rlike(c, F.lit("=[0-9a-f]+$")), 1).otherwise(2)
    changed = pii_surrogates.pairs(docs.where("text like 'password%'"), KEY)
    assert changed.where(kind(F.col("entity")) != kind(F.col("surrogate"))).count() == 0 and changed.count() == len(secrets)


def test_names_keep_their_surrogates_word_by_word(spark):
    text = "Mr Jon Smith met Peter Miller. Smith left; then Miller and Jon came with Smithson. MR X."
    (row,) = pii_surrogates.replace(spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY).collect()
    m = re.fullmatch(r"Mr (\w+) (\w+) met (\w+) (\w+)\. (\w+) left; then (\w+) and (\w+) came with Smithson\. MR X\.", row["text"])
    assert m and m[2] == m[5] and m[4] == m[6] and m[1] == m[7]
    assert m[3] in pii_surrogates.GIVEN_NAMES["latin male"].split() and len({m[1], m[2], m[3], m[4]} | {"Jon", "Smith", "Peter", "Miller"}) == 8
    assert row["__pii_found"] == ["Mr Jon Smith", "Peter Miller", "Smith", "Miller", "Jon"]
    others = [pii_surrogates.surrogate(F.lit("Mr Jon Smith"), k).alias(k) for k in ("one", "two")]
    assert len(set(spark.range(1).select(*others).first())) == 2


def test_awkward_rows(awkward, none, spark):
    n = len(AWKWARD)
    runs = {
        "language": language_id.identify, "fingerprints": fingerprint_cws.fingerprints, "mix": source_mix.mix, "dedup": simhash_dedup.near_duplicates, "similar": simhash_dedup.similar_documents, "pii": lambda d: pii_surrogates.replace(d, KEY),
        "toxicity": lambda d: toxicity.judge(d, spark.createDataFrame([(2, 1), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")),
    }
    for name, run in runs.items():
        assert run(awkward).count() == n, name
        assert run(none).count() == 0, name
    assert packing.pack(packing.pieces(awkward)).select("doc_id").distinct().count() == 9
    assert packing.pack(packing.pieces(none)).count() == 0
    lang = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(awkward).collect()}
    assert lang[1] == lang[2] == lang[7] == lang[9] == "und"
    pages = spark.createDataFrame([(1, None, None, 1), (2, "http://a.b/", "", 1), (None, "x", "<p>unclosed <b>text", 1), (3, "http://a.b/", "<" * 2000, 1), (3, "http://a.b/", "<div>" * 3000 + "deep", 1)], "page_id long, url string, html string, host int")
    texts = [r["text"] for r in site_style.main_text(pages).collect()]
    assert len(texts) == 5 and "unclosed text" in texts and "deep" in texts
    assert site_style.main_text(pages.limit(0)).count() == 0
    assert url_rules.judge(pages).count() == 5 and url_rules.judge(pages.limit(0)).count() == 0
    assert maxscore.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
