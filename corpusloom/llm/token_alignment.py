"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode every whole text; a token covers a range of the text's bytes. Per batch of documents, keyed by
document, ``pandas.merge_asof`` finds for each token start of one side the other side's token that covers it; the
union of both directions gives all overlapping pairs (links), and byte offsets where tokens of both sides end cut the
text into groups.

How often a pair of ids is linked in the whole corpus is counted by pre-aggregating: documents are gathered in blocks
of some megabytes as they are read, a block holds each id pair once with its count, and only these rows are shuffled,
first to be summed, then to bring the corpus-wide counts back to the documents of the block. A frequent pair is one
row per block, and no table of pairs is broadcast or gathered.

Edge cases: texts that are null or empty, and those whose tokens' bytes are not the text's (a tokenizer that
normalises), have no tokens: counts of zero, empty arrays and an empty digest. Null and repeated ids are kept, each row
for itself. Special tokens' strings inside a text are plain text. An empty table gives an empty result; further
columns of the input take no part.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes of text that one call of merge_asof takes (more only for one longer text), and those of a block of documents.
BATCH_BYTES, BLOCK_BYTES = 300_000, 4_000_000
#: Characters whose classes all regular-expression engines in question agree on; other texts take the slower encoder.
_COMMON = re.compile(r"[\x00-\u024F\u0370-\u052F\u2010-\u2027\u20A0-\u20BF]*")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for themselves, the rest counted on from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file of ``tokenizers``: ids of texts, with a space before each, and the bytes of each id.

    Where the file's merges are in the order of its ids and its only splitting is the byte-level pattern, ids come from
    ``tiktoken`` over the same vocabulary, which is several times faster; texts with characters outside ``_COMMON`` are
    encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        size, alphabet = self.slow.get_vocab_size(), byte_alphabet()
        special = {i: t.content for i, t in self.slow.get_added_tokens_decoder().items()}
        spelled = [special.get(i) or self.slow.id_to_token(i) or "" for i in range(size)]
        self.bytes = [t.encode() if i in special else bytes(alphabet[c] for c in t) for i, t in enumerate(spelled)]
        self.fast = self._fast(path, set(special))

    def _fast(self, path: str, special: set[int]):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, before = told["model"], told["pre_tokenizer"]
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        in_order = [model["vocab"].get(t) for t in joined] == list(range(256, 256 + len(joined)))
        if not in_order or told["normalizer"] or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"] or model["ignore_merges"]:
            return None
        ranks = {b: i for i, b in enumerate(self.bytes) if i not in special}
        return tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        one = lambda t: self.slow.encode(t, add_special_tokens=False).ids
        quick = self.fast.encode_ordinary if self.fast else one
        return [np.array((quick if _COMMON.fullmatch(t) else one)(" " + t), np.int32) for t in texts]


class Pieces:
    """A ``sentencepiece`` model: ids of texts, before each of which the model puts a space itself, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.model.encode(texts, num_threads=1)]


@functools.lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


class Strings:
    """Byte strings by number, put together many at a time."""

    def __init__(self, strings: list[bytes]):
        self.length = np.array([len(x) for x in strings], np.int64)
        self._begin = np.cumsum(self.length) - self.length
        self._bytes = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The bytes of the strings one behind the other."""
        lengths = self.length[numbers]
        shift = self._begin[numbers] - (np.cumsum(lengths) - lengths)
        return self._bytes[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


@functools.lru_cache(maxsize=4)
def _spellings(tokens: ByteLevel | Pieces) -> Strings:
    return Strings(tokens.bytes)


@dataclass
class Aligned:
    """The tokens of a batch of documents. Arrays over tokens of side A and B: document (position in the batch), id,
    start and end (bytes; those of document k begin at ``base[k]``), and whether a group ends with the token. Links:
    positions in these arrays."""

    base: np.ndarray
    doc: tuple[np.ndarray, np.ndarray]
    ids: tuple[np.ndarray, np.ndarray]
    start: tuple[np.ndarray, np.ndarray]
    end: tuple[np.ndarray, np.ndarray]
    last: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]

    def per_document(self, positions: np.ndarray) -> np.ndarray:
        return np.bincount(positions, minlength=len(self.base))


def covering(side: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
    """For each token start of one side the position of the other side's token that covers it, by document."""
    return pd.merge_asof(side, other, on="start", by="doc", direction="backward")["position"].to_numpy()


def align(texts: list[str | None], tokens: tuple[ByteLevel, Pieces]) -> Aligned:
    """Tokens, links and group ends of a batch of texts; texts without tokens have none of them."""
    chosen = [k for k, t in enumerate(texts) if t]
    wholes = [(" " + texts[k]).encode() for k in chosen]
    sizes = np.array([len(w) for w in wholes], np.int64)
    flat, counts, good = [], [], np.ones(len(chosen), bool)
    whole = np.frombuffer(b"".join(wholes), np.uint8)
    for side in tokens:
        each = side([texts[k] for k in chosen])
        n = np.array([len(x) for x in each], np.int64)
        ids = np.concatenate([np.zeros(0, np.int32), *each]).astype(np.int64)
        covered = np.diff(np.concatenate(([0], np.cumsum(_spellings(side).length[ids])))[np.concatenate(([0], np.cumsum(n)))])
        spelled = _spellings(side).joined(ids)
        if not (np.array_equal(covered, sizes) and np.array_equal(spelled, whole)):
            cuts = np.cumsum(covered)
            good &= np.array([spelled[b - a : b].tobytes() == w for a, b, w in zip(covered, cuts, wholes, strict=True)], bool)
        flat.append(ids)
        counts.append(n)
    chosen_at = np.array(chosen, np.int64)
    base = np.zeros(len(texts), np.int64)
    kept_sizes = np.where(good, sizes, 0)
    base[chosen_at] = np.cumsum(kept_sizes) - kept_sizes
    doc, ids, start, end = [], [], [], []
    for side, all_ids, n in zip(tokens, flat, counts, strict=True):
        keep = np.repeat(good, n)
        own = all_ids[keep]
        ends = np.cumsum(_spellings(side).length[own])
        doc.append(np.repeat(chosen_at, n)[keep])
        ids.append(own)
        start.append(ends - _spellings(side).length[own])
        end.append(ends)
    frames = [pd.DataFrame({"start": s, "doc": d, "position": np.arange(len(s))}) for s, d in zip(start, doc, strict=True)]
    b_of_a, a_of_b = covering(frames[0].drop(columns="position"), frames[1]), covering(frames[1].drop(columns="position"), frames[0])
    # Tokens that start together are found from both sides and count once.
    later = np.flatnonzero(start[1] != start[0][a_of_b]) if len(a_of_b) else np.zeros(0, np.int64)
    links = np.concatenate((np.arange(len(b_of_a)), a_of_b[later])).astype(np.int64), np.concatenate((b_of_a, later)).astype(np.int64)
    ends_here = [np.zeros(int(kept_sizes.sum()) + 1, bool) for _ in tokens]
    for marks, e in zip(ends_here, end, strict=True):
        marks[e] = True
    last = ends_here[1][end[0]], ends_here[0][end[1]]
    return Aligned(base, tuple(doc), tuple(ids), tuple(start), tuple(end), last, links)


@functools.lru_cache(maxsize=1)
def _decimals(size: int) -> Strings:
    """Each id in decimal with a comma, a bar and a semicolon behind it."""
    return Strings([f"{i}{mark}".encode() for i in range(size) for mark in ",|;"])


def group_digests(found: Aligned, size: int) -> list[str]:
    """For each document the SHA-256 of its groups, `a1,a2|b1;a3|b2,b3`; without tokens an empty string."""
    a_last, b_last = found.last
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    groups = int(a_last.sum())
    a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    b_before, a_through = np.cumsum(b_in) - b_in, np.cumsum(a_in)
    codes = np.empty(len(a_group) + len(b_group), np.int64)
    codes[np.arange(len(a_group)) + b_before[a_group]] = 3 * found.ids[0] + a_last
    codes[np.arange(len(b_group)) + a_through[b_group]] = 3 * found.ids[1] + 2 * b_last
    cuts = np.concatenate(([0], np.cumsum(found.per_document(found.doc[0]) + found.per_document(found.doc[1]))))
    decimals = _decimals(size)
    text, ends = decimals.joined(codes).tobytes(), np.concatenate(([0], np.cumsum(decimals.length[codes])))[cuts]
    return [hashlib.sha256(text[a : b - 1]).hexdigest() if a < b else "" for a, b in itertools.pairwise(ends.tolist())]


def _batches(texts: pd.Series):
    """Slices of a column of texts, of BATCH_BYTES or one text each."""
    begin, held = 0, 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > BATCH_BYTES:
            yield begin, k
            begin, held = k, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The alignment of each document: doc_id, the ids and byte ends (in space+text) of both sides' tokens, the byte
    ends of the groups, and the links as pairs of token positions (from 0) of A and B."""
    default = default_paths()
    paths = (path_a or default[0], path_b or default[1])

    def run(batches):
        tokens = tokenizers_of(*paths)
        for batch in batches:
            for a, b in _batches(batch["text"]):
                found = align(batch["text"].iloc[a:b].tolist(), tokens)
                cuts = [np.cumsum(found.per_document(d))[:-1] for d in found.doc]
                first = [np.searchsorted(d, np.arange(b - a)) for d in found.doc]
                order = np.lexsort((found.links[1], found.links[0]))
                i, j = found.links[0][order], found.links[1][order]
                k = found.doc[0][i]
                link_cuts = np.cumsum(found.per_document(k))[:-1]
                ends = [np.split(e - found.base[d], c) for e, d, c in zip(found.end, found.doc, cuts, strict=True)]
                marks = np.split(found.last[0], cuts[0])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "a_ids": np.split(found.ids[0], cuts[0]), "b_ids": np.split(found.ids[1], cuts[1]), "a_ends": ends[0], "b_ends": ends[1],
                    "group_ends": [e[m] for e, m in zip(ends[0], marks, strict=True)], "link_a": np.split(i - first[0][k], link_cuts), "link_b": np.split(j - first[1][k], link_cuts),
                })

    many = ", ".join(f"{c} array<long>" for c in ("a_ids", "b_ids", "a_ends", "b_ends", "group_ends", "link_a", "link_b"))
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id long, {many}")


def _counted(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Two kinds of rows: a document with its counts, digest and each linked id pair once, and a block with the pairs of
    its documents. A pair is the code id of A x size of B + id of B."""

    def run(batches):
        tokens = tokenizers_of(*paths)
        width, size = len(tokens[1].bytes), max(len(t.bytes) for t in tokens)
        pairs = len(tokens[0].bytes) * width
        block, seen, held = TaskContext.get().partitionId() << 32, [], 0

        def close():
            codes, at = np.unique(np.concatenate([c for c, _ in seen]), return_inverse=True)
            times = np.bincount(at, np.concatenate([n for _, n in seen]), len(codes)).astype(np.int64)
            return pd.DataFrame({"block": [block], "is_block": True, "doc_id": None, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "codes": [codes], "times": [times]})

        for batch in batches:
            for a, b in _batches(batch["text"]):
                texts = batch["text"].iloc[a:b].tolist()
                found = align(texts, tokens)
                i, j = found.links
                k = found.doc[0][i]
                keys, times = np.unique(k * pairs + found.ids[0][i] * width + found.ids[1][j], return_counts=True)
                of, codes = np.divmod(keys, pairs)
                cuts = np.cumsum(found.per_document(of))[:-1]
                counts = {"n_a": found.doc[0], "n_b": found.doc[1], "n_groups": found.doc[0][found.last[0]], "n_links": k}
                yield pd.DataFrame({
                    "block": block, "is_block": False, "doc_id": batch["doc_id"].iloc[a:b].to_numpy(), **{c: found.per_document(d) for c, d in counts.items()},
                    "groups_sha256": group_digests(found, size), "codes": np.split(codes, cuts), "times": np.split(times, cuts),
                })
                seen.append((codes, times))
                held += sum(len(t) for t in texts if t)
                if held >= BLOCK_BYTES:
                    yield close()
                    block, seen, held = block + 1, [], 0
        if seen:
            yield close()

    schema = "block long, is_block boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<long>, times array<long>"
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """(code, total, best): how many links of the corpus have the id pair, and whether no pair of its B id has more."""
    totals = written(blocks.groupBy("code").agg(F.sum("n").alias("total")).withColumn("b", F.col("code") % width), "pair_counts")
    top = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(top, "b").select("code", "total", (F.col("total") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    default = default_paths()
    paths = (path_a or default[0], path_b or default[1])
    found = written(_counted(docs, paths), "alignments")
    blocks = found.where("is_block").select("block", F.inline(F.arrays_zip("codes", "times"))).toDF("block", "code", "n")
    counts = pair_counts(blocks, len(tokenizers_of(*paths)[1].bytes))
    rated = blocks.select("block", "code").join(counts, "code").select("block", "code", "total", "best")

    def rate(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("code")
        codes, total, best = (known[c].to_numpy() for c in ("code", "total", "best"))
        at = [np.searchsorted(codes, c) for c in rows["codes"]]
        rows["n_best"] = [int(n[best[i]].sum()) for i, n in zip(at, rows["times"], strict=True)]
        rows["count_sum"] = [int((n * total[i]).sum()) for i, n in zip(at, rows["times"], strict=True)]
        return rows[RESULT]

    each = found.where("not is_block").drop("is_block").groupBy("block").cogroup(rated.groupBy("block"))
    return each.applyInPandas(rate, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
