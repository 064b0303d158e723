"""Best-fit packing of token sequences with swap-based local search.

Documents become token ids (a public tokenizer, then an end id); those longer than a sequence are cut. Pieces
are dealt to groups by hash. Each group is packed best-fit in decreasing length, then improved: between underfull
bins, moves and one-for-one and two-for-one exchanges that raise the sum of squared fills are made until a bin is
empty or nothing improves. What is then still underfull meets in fewer, second groups for one more round.

Edge cases: null texts are empty and hold the end id alone; repeated rows are packed each for itself; pieces of
full length are sequences of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SEQUENCE = 4096
END_ID = 1
#: Pieces to a group of the first round, and groups of the first round to one of the second.
GROUP_PIECES, MERGED_GROUPS = 4000, 32
#: Bins of a group that a second round takes up again, the emptiest.
REOPENED = 24
CACHE_WORDS = 500_000


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Token ids of whole texts from ids of their words between ASCII blanks, each word encoded once.

    The tokenizer splits at white space before anything else and drops it, so a text's ids are its words' ids. It
    also lowers letters and parts them from marks, so a plain word with marks behind it is two known pieces. What is
    not known is encoded in one go, with a special token between the words. Words stay known for a generation of
    ``CACHE_WORDS`` words after they were last seen.
    """

    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&$#*()|-]*)")

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        self.encode = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        self.mark = "<|endoftext|>"
        self.is_mark = np.arange(tokenizer.get_vocab_size()) == tokenizer.token_to_id(self.mark)
        self.is_end = np.array([(tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(tokenizer.get_vocab_size())])
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str], letters: bool) -> None:
        """Makes words known. Those of letters alone each end in a token that ends a word; others get a mark between."""
        for at in range(0, len(words), 5000):
            some = words[at : at + 5000]
            ids = self.encode((" " if letters else self.mark).join(some))
            ends = np.flatnonzero((self.is_end if letters else self.is_mark)[ids]).tolist()
            if len(ends) != len(some) - (not letters):  # a word holds the mark, or ends oddly
                for w in some:
                    self.known[w] = self.encode(w).tobytes()
                continue
            data = ids.tobytes()
            begins, stops = ([0, *(e + 1 for e in ends[:-1])], [e + 1 for e in ends]) if letters else ([0, *(e + 1 for e in ends)], [*ends, len(ids)])
            for w, i, j in zip(some, begins, stops, strict=True):
                self.known[w] = data[4 * i : 4 * j]

    def _meet(self, words: set[str]) -> None:
        known, old, parts, cores, rest = self.known, self.old, {}, set(), set()
        for w in words:
            if w in old:
                known[w] = old[w]
            elif m := self._PLAIN.fullmatch(w):
                core, marks = m[1].lower(), m[2]
                parts[w] = (core, marks)
                cores.add(core)
                rest.add(marks)
            else:
                rest.add(w)
        for some in (cores, rest):
            for p in [p for p in some if p in known or p in old]:
                some.discard(p)
                known.setdefault(p, old.get(p))
        self._learn(sorted(cores), True)
        self._learn(sorted(rest), False)
        for w, (core, marks) in parts.items():
            known[w] = known[core] + known[marks]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > CACHE_WORDS:
            self.old, self.known = self.known, {}
        known = self.known
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        found = [list(map(known.get, part)) for part in split]
        gaps = [[i for i, v in enumerate(values) if v is None] if None in values else [] for values in found]
        self._meet({part[i] for part, some in zip(split, gaps, strict=True) for i in some})
        for part, values, some in zip(split, found, gaps, strict=True):
            for i in some:
                values[i] = known[part[i]]
        return [np.frombuffer(b"".join(values), "<u4") for values in found]


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces."""
    path = tokenizer_path or default_tokenizer_path()
    end = np.array([end_id], "<u4")

    def cut(batches):
        encode = _word_ids(path)
        for batch in batches:
            for at in range(0, len(batch), 512):
                some = batch.iloc[at : at + 512]
                rows = []
                for doc, ids in zip(some["doc_id"], encode(["" if t is None else t for t in some["text"]]), strict=True):
                    ids = np.concatenate((ids, end))
                    rows += [(doc, k, s, len(p := ids[s : s + sequence]), zlib.crc32(p.tobytes())) for k, s in enumerate(range(0, len(ids), sequence))]
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of positions, packed best-fit in decreasing length."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([i])
            left, b = size - lengths[i], len(bins) - 1
        else:
            left, b = room.pop(at)
            bins[b].append(i)
            left -= lengths[i]
        if left:
            insort(room, (left, b))
    return bins


def local_search(bins: list[list[int]], lengths: list[int], size: int, patience: int = 400) -> list[list[int]]:
    """Empties underfull bins by moves, one-for-one and two-for-one exchanges that raise the sum of squared fills."""
    bins = [list(b) for b in bins if b]
    fill = [sum(lengths[i] for i in b) for b in bins]
    fewest = -(-sum(fill) // size)
    for _ in range(patience):
        open_bins = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < size), key=lambda b: fill[b])
        if len(open_bins) < 2 or sum(1 for b in bins if b) <= fewest:
            break
        if not _improve(open_bins, bins, fill, lengths, size):
            break
    return [b for b in bins if b]


def _improve(open_bins: list[int], bins: list[list[int]], fill: list[int], lengths: list[int], size: int) -> bool:
    """One pass from the emptiest bin: its pieces go to fuller bins, or change places with smaller ones there."""
    for low in open_bins[:8]:
        changed = False
        for high in sorted(open_bins, key=lambda b: -fill[b]):
            if high == low or not bins[low] or fill[high] < fill[low]:
                continue
            room = size - fill[high]
            if room <= 0:
                continue
            gain, best = 0, None
            mine = sorted(bins[low], key=lambda i: lengths[i])
            theirs = sorted(bins[high], key=lambda i: lengths[i])
            sizes = [lengths[i] for i in theirs]
            for i in mine:
                a = lengths[i]
                if a <= room and a > gain:
                    gain, best = a, ([i], [])
                at = bisect_left(sizes, a - room)
                if at < len(sizes) and 0 < a - sizes[at] <= room and a - sizes[at] > gain:
                    gain, best = a - sizes[at], ([i], [theirs[at]])
            for x in range(len(mine)):
                for y in range(x + 1, len(mine)):
                    a = lengths[mine[x]] + lengths[mine[y]]
                    at = bisect_left(sizes, a - room)
                    if at < len(sizes) and 0 < a - sizes[at] <= room and a - sizes[at] > gain:
                        gain, best = a - sizes[at], ([mine[x], mine[y]], [theirs[at]])
                if x > 40:
                    break
            if best:
                for i in best[0]:
                    bins[low].remove(i)
                    bins[high].append(i)
                for i in best[1]:
                    bins[high].remove(i)
                    bins[low].append(i)
                fill[low] -= gain
                fill[high] += gain
                changed = True
        if changed:
            return True
    return False


def _packed(rows: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each row, and each bin's fill."""
    lengths = rows["length"].tolist()
    bins = local_search(best_fit(lengths, size), lengths, size)
    where, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    fill = np.zeros(len(bins), np.int64)
    for b, members in enumerate(bins):
        for i in members:
            where[i], offset[i] = b, fill[b]
            fill[b] += lengths[i]
    return where, offset, fill


def pack(cut: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to the pieces of ``pieces``.

    A sequence's number holds its group and its bin in the group; sequences of one full piece have negative numbers.
    """
    cut = written(cut.withColumn("row", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())), "pieces")
    total = cut.where(F.col("length") < sequence).count()
    groups = max(1, -(-total // GROUP_PIECES))
    merged = max(1, -(-groups // MERGED_GROUPS))
    full = cut.where(F.col("length") >= sequence)
    rest = cut.where(F.col("length") < sequence).withColumn("team", F.pmod("row", F.lit(groups)))
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        where, offset, fill = _packed(rows, sequence)
        again = np.isin(where, [b for b in np.argsort(fill, kind="stable")[:REOPENED] if fill[b] < sequence])
        team = int(rows["team"].iloc[0])
        return rows[wanted].assign(offset=offset, sequence_id=(team << 24) + where, team=np.where(again, team % merged, -1))

    def second(rows: pd.DataFrame) -> pd.DataFrame:
        where, offset, _ = _packed(rows, sequence)
        team = int(rows["team"].iloc[0])
        return rows[wanted].assign(offset=offset, sequence_id=((groups + team) << 24) + where)

    packed = written(rest.groupBy("team").applyInPandas(first, f"{fields}, offset long, sequence_id long, team long"), "packed")
    reopened = packed.where("team >= 0").groupBy("team").applyInPandas(second, f"{fields}, offset long, sequence_id long")
    done = packed.where("team < 0").drop("team").unionByName(reopened)
    alone = full.withColumn("offset", F.lit(0).cast("long")).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    return done.unionByName(alone).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
