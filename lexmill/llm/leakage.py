"""Problem 8: evaluation texts leaking into training text: rare n-gram seeds, then Smith-Waterman alignment.

Texts are compared as words without case, accents, mark-up and punctuation. A leak keeps at least WINDOW words on end of an item's stem
with at most one word in EDIT_SHARE edited, so of a window's word 3-grams at least KEPT survive any such edits; a window is therefore
still found when its KEPT - 1 most frequent ones in the corpus are left out of the seeds. Frequencies are counted over the whole
corpus in a first pass. In the second pass each worker looks the seeds up, keeps a hit only if enough words of a window match near its
diagonal (again a bound no leak can miss), and aligns what is left. Items are a stated query set: they go out in blocks of bounded size.

Where sentences occur in any order the limit on edits holds for the stem as a whole, so a sentence may have more than its share. But
sentences are cut into parts of at most WINDOW words, and each part gets so many edits that not all parts can have more than theirs; a part
is a candidate with no more than these, and has so many seeds that one survives them. Stems for which that cannot be had, as most of their
sentences have one or two words, are tried on every document that holds enough of their words.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import bounded_batches, spread

GRAM, WINDOW, EDIT_SHARE = 3, 18, 6
EDITS = WINDOW // EDIT_SHARE
KEPT = WINDOW - GRAM + 1 - GRAM * EDITS
REACH = WINDOW
BLOCK_ITEMS = 5_000
CACHE = 200_000
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def plain(word: str) -> str:
    """Lower case without accents; text decoded with the wrong table is put right first."""
    if "Ã" in word or "â" in word or "Å" in word:
        try:
            word = word.encode("cp1252").decode("utf-8")
        except UnicodeError:
            pass
    word = word.lower().replace("œ", "oe").replace("æ", "ae").replace("ß", "ss")
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def repaired(text: str) -> str:
    """Tags, entities, soft hyphens, loose accents and wrongly decoded characters put right."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "Ã" in text or "â€" in text:
        for table in ("cp1252", "latin-1"):
            try:
                text = text.encode(table).decode("utf-8")
                break
            except UnicodeError:
                pass
    return text.replace("\xad", "")


class Ids(dict):
    """white-space token -> ids of its plain words among the items' words (0 for others); remembered for up to CACHE tokens."""

    def __init__(self, words: dict[str, int]):
        self.words = words

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        ids = tuple(self.words.get(w, 0) for w in plain_words(token))
        if len(token) <= 40:
            self[token] = ids
        return ids


def plain_words(text: str) -> list[str]:
    return _WORD.findall(plain(text))


def grams(ids: np.ndarray) -> np.ndarray:
    """A 64-bit key for each run of GRAM ids."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64)
    key = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            key = (key ^ x[k : k + n]) * _MIX
            key ^= key >> np.uint64(29)
    return key


def shares(spans: list[tuple[int, int]]) -> list[tuple[int, int, int]] | None:
    """(begin, end, edits) of the parts of sentences that a stem is looked for by. If each part had more edits than here, the stem would
    have more than one in EDIT_SHARE; and of each part one gram survives its edits. None if no choice of parts has both."""
    parts = []
    for a, z in spans:
        n = -(-(z - a) // WINDOW)
        parts += [(a + k * (z - a) // n, a + (k + 1) * (z - a) // n) for k in range(n)]
    allowed = sum(z - a for a, z in spans) // EDIT_SHARE
    for least in (2 * GRAM, GRAM):
        some = [(a, z) for a, z in parts if z - a >= least]
        words = sum(z - a for a, z in some)
        out = [(a, z, min(allowed * (z - a) // words, (z - a) // GRAM - 1)) for a, z in some]
        if sum(e + 1 for *_, e in out) > allowed:
            return out
    return None


class Index:
    """The items of a block: words, stems as ids, sentence spans, and the sorted keys of all their grams with where they occur."""

    def __init__(self, items: list[tuple[int, str]]):
        self.words: dict[str, int] = {}
        self.item_ids, stems, self.spans = [], [], []
        for item_id, stem in items:
            ids, spans = [], []
            for s in _SENTENCE.split(stem or ""):
                more = [self.words.setdefault(w, len(self.words) + 1) for w in plain_words(repaired(s))]
                if more:
                    spans.append((len(ids), len(ids) + len(more)))
                    ids += more
            if ids:
                self.item_ids.append(item_id)
                stems.append(np.array(ids, np.int32))
                self.spans.append(spans)
        self.stems = stems
        gap = np.full(REACH + GRAM, -1, np.int32)  # so that no window sees two items
        self.flat = np.concatenate([gap, *(x for s in stems for x in (s, gap))])
        self.first = len(gap) + np.cumsum([0, *(len(s) + len(gap) for s in stems)])  # an item's place in flat
        keys, at = [], []
        for i, s in enumerate(stems):
            g = grams(s)
            keys.append(g)
            at.append(self.first[i] + np.arange(len(g)))
        k, p = np.concatenate([*keys, np.zeros(0, np.uint64)]), np.concatenate([*at, np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(k, kind="stable")
        self.keys, start = np.unique(k[order], return_index=True)
        self.place, self.start = p[order], np.append(start, len(k))
        self.gram_of = np.full(len(self.flat), -1, np.int64)  # number of the gram beginning at a place
        for g in range(len(self.keys)):
            self.gram_of[self.place[self.start[g] : self.start[g + 1]]] = g
        self.sentence_size, self.sentence_first, self.sentence_least = (np.zeros(len(self.flat), np.int64) for _ in range(3))
        apart = [shares(spans) for spans in self.spans]
        self.rest = [i for i, parts in enumerate(apart) if parts is None]
        self.apart = [parts or [] for parts in apart]
        for i, sentences in enumerate(self.apart):
            for a, z, edits in sentences:
                at = slice(self.first[i] + a, self.first[i] + z)
                self.sentence_size[at], self.sentence_first[at], self.sentence_least[at] = z - a, self.first[i] + a, z - a - edits
        self.least = min([WINDOW - EDITS, *(z - a - edits for sentences in self.apart for a, z, edits in sentences)])
        self._filter(np.ones(len(self.keys), bool))

    def _filter(self, use: np.ndarray) -> None:
        self.use = use
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys[use] >> np.uint64(44)).astype(np.int64)] = True

    def keep_rare(self, counts: np.ndarray) -> None:
        """Seeds: grams that are in some window not among its KEPT - 1 most frequent ones (ties by number), and so for sentences."""
        use = np.zeros(len(self.keys), bool)
        width = WINDOW - GRAM + 1
        for i in range(len(self.stems)):
            g = self.gram_of[self.first[i] : self.first[i] + len(self.stems[i])]
            g = g[g >= 0]
            for a in range(max(1, len(g) - width + 1)):
                w = g[a : a + width]
                use[w[np.lexsort((w, counts[w]))][: max(1, len(w) - KEPT + 1)]] = True
            for a, z, edits in self.apart[i]:
                w = self.gram_of[self.first[i] + a : self.first[i] + z - GRAM + 1]
                kept = max(1, len(w) - GRAM * edits)
                use[w[np.lexsort((w, counts[w]))][: len(w) - kept + 1]] = True
        self._filter(use)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of used grams in ids, and their numbers."""
        key = grams(ids)
        at = np.flatnonzero(self.bits[(key >> np.uint64(44)).astype(np.int64)]) if len(key) else np.zeros(0, np.int64)
        g = np.searchsorted(self.keys, key[at])
        g[g == len(self.keys)] = 0
        ok = (self.keys[g] == key[at]) & self.use[g] if len(self.keys) else np.zeros(0, bool)
        return at[ok], g[ok]


def encode(ids: Ids, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of all texts with a gap of zeros after each, and where each begins."""
    out: list[int] = []
    begin, gap = [], [0] * GRAM
    look = ids.__getitem__
    for t in texts:
        begin.append(len(out))
        if t:
            out.extend(chain.from_iterable(map(look, repaired(t).split())))
        out.extend(gap)
    return np.array(out, np.int32), np.array([*begin, len(out)], np.int64)


def candidates(index: Index, ids: np.ndarray, begin: np.ndarray, chunk: int = 200_000) -> list[tuple[int, int, int]]:
    """(text, item, diagonal) of hits where, within EDITS of the diagonal, a window holding the seed has WINDOW - EDITS matching words,
    or a part of a sentence has all but its edits."""
    found = by_words(index, ids, begin)
    at, g = index.hits(ids)
    if not len(at):
        return sorted(found)
    n = index.start[g + 1] - index.start[g]
    pos = np.repeat(at, n)
    place = index.place[np.repeat(index.start[g] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    # one hit of a run on the same diagonal is enough
    diagonal = pos - place
    order = np.lexsort((pos, diagonal))
    pos, place, diagonal = pos[order], place[order], diagonal[order]
    item = np.searchsorted(index.first, place, "right") - 1
    fresh = np.ones(len(pos), bool)
    fresh[1:] = (diagonal[1:] != diagonal[:-1]) | (item[1:] != item[:-1]) | (pos[1:] - pos[:-1] > GRAM)
    pos, place, item = pos[fresh], place[fresh], item[fresh]
    width = 2 * REACH + GRAM
    stems = sliding_window_view(index.flat, width)  # row q - REACH is centred on place q
    around = sliding_window_view(np.concatenate([np.full(REACH + EDITS, -2, np.int32), ids, np.full(width + EDITS, -2, np.int32)]), width + 2 * EDITS)
    for a in range(0, len(pos), chunk):
        p, q, i = pos[a : a + chunk], place[a : a + chunk], item[a : a + chunk]
        stem, text = stems[q - REACH], around[p]
        hit = stem == text[:, :width]
        for d in range(1, 2 * EDITS + 1):
            hit |= stem == text[:, d : d + width]
        some = np.flatnonzero(hit.sum(1, dtype=np.uint8) >= index.least)
        p, q, i, hit = p[some], q[some], i[some], hit[some]
        total = np.zeros((len(p), width + 1), np.int8)
        np.cumsum(hit, 1, dtype=np.int8, out=total[:, 1:])
        good = (total[:, WINDOW:] - total[:, :-WINDOW]).max(1, initial=0) >= WINDOW - EDITS
        size, lo = index.sentence_size[q], REACH - (q - index.sentence_first[q])
        rows = np.flatnonzero(size)
        lo, size = lo[rows], size[rows]
        good[rows] |= total[rows, lo + size] - total[rows, lo] >= index.sentence_least[q[rows]]
        t = np.searchsorted(begin, p[good], "right") - 1
        found |= set(zip(t.tolist(), i[good].tolist(), (p - q + index.first[i])[good].tolist(), strict=True))
    return sorted(found)


def by_words(index: Index, ids: np.ndarray, begin: np.ndarray) -> set[tuple[int, int, int]]:
    """(text, item, its beginning) for the stems that no seed is proven for: texts with all their words but as many as may be edited."""
    found = set()
    for i in index.rest:
        wanted = np.unique(index.stems[i])
        at = np.flatnonzero(np.isin(ids, wanted))
        text = np.searchsorted(begin, at, "right") - 1
        n = np.bincount(np.unique(text * (len(index.words) + 1) + ids[at]) // (len(index.words) + 1), minlength=1)
        found |= {(int(t), i, int(begin[t])) for t in np.flatnonzero(n >= max(1, len(wanted) - len(index.stems[i]) // EDIT_SHARE))}
    return found


def align(stem: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Smith-Waterman over words (match 2, mismatch and gap -1): the best local alignment as (stem place or -1, matches 1/0)."""
    n, m = len(stem), len(text)
    h = np.zeros((n + 1, m + 1), np.int32)
    ramp = np.arange(m + 1)
    for i in range(1, n + 1):
        row = np.maximum(h[i - 1] - 1, 0)
        row[1:] = np.maximum(row[1:], h[i - 1, :-1] + np.where(text == stem[i - 1], 2, -1))
        h[i] = np.maximum.accumulate(row + ramp) - ramp
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    path = []
    while i and j and h[i, j] > 0:
        same = stem[i - 1] == text[j - 1]
        if h[i, j] == h[i - 1, j - 1] + (2 if same else -1):
            path.append((i - 1, int(same)))
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] - 1:
            path.append((i - 1, 0))
            i -= 1
        else:
            path.append((-1, 0))
            j -= 1
    return path[::-1]


def fewest_edits(part: np.ndarray, text: np.ndarray) -> int:
    """Fewest words changed, added or missing between part and any passage of the text."""
    ramp = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for w in part:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != w))
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def longest_kept(path: list[tuple[int, int]]) -> tuple[int, int]:
    """Most stem words on end in the alignment with at most one edit per EDIT_SHARE words, and the edits among them."""
    words = np.cumsum([0, *(p >= 0 for p, _ in path)])
    edits = np.cumsum([0, *(1 - same for _, same in path)])
    best = (0, 0)
    for a in range(len(path)):
        w, e = words[a + 1 :] - words[a], edits[a + 1 :] - edits[a]
        ok = np.flatnonzero(e * EDIT_SHARE <= w)
        if len(ok) and w[ok[-1]] > best[0]:
            best = (int(w[ok[-1]]), int(e[ok[-1]]))
    return best


def judge(index: Index, item: int, text: np.ndarray, diagonals: list[int]) -> tuple[int, int, str] | None:
    """(words kept on end, edits, kind) if the text leaks the item: 'passage', or 'sentences' where all its sentences occur apart."""
    stem = index.stems[item]
    best = (0, 0)
    for d in diagonals:
        a, z = max(0, d - WINDOW), max(0, min(len(text), d + len(stem) + WINDOW))
        best = max(best, longest_kept(align(stem, text[a:z])), key=lambda x: x[0])
        if best[0] == len(stem):
            break
    if best[0] >= min(WINDOW, len(stem)):
        return (*best, "passage")
    edits = 0
    for s, e in index.spans[item]:
        edits += fewest_edits(stem[s:e], text)
        if edits * EDIT_SHARE > len(stem):
            return None
    return len(stem), edits, "sentences"


def _count(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, n = Ids(index.words), np.zeros(len(index.keys), np.int64)
        for b in batches:
            n += np.bincount(index.hits(encode(ids, b.column(0).to_pylist())[0])[1], minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    return run


def _search(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(index.words)
        for b in batches:
            keys, out = b.column(0).to_pylist(), []
            flat, begin = encode(ids, b.column(1).to_pylist())
            pairs: dict[tuple[int, int], list[int]] = {}
            for t, i, d in candidates(index, flat, begin):
                pairs.setdefault((t, i), []).append(d - int(begin[t]))
            for (t, i), ds in pairs.items():
                apart = [d for k, d in enumerate(sorted(ds)) if k == 0 or d - sorted(ds)[k - 1] > EDITS]
                if got := judge(index, i, flat[begin[t] : begin[t + 1] - GRAM], apart):
                    out.append((keys[t], index.item_ids[i], *got, got[0] / len(index.stems[i])))
            if out:
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "item_id", "words", "edits", "kind", "share"])

    return run


KIND = "doc_id bigint, item_id bigint, words int, edits int, kind string, share double"


def leaks(docs: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, words (of the stem, on end), edits, kind ('passage' or 'sentences'), share (of the stem) of each leak.

    docs: doc_id, text; items: item_id, stem; other columns are ignored. Every document is searched for every item; items come in
    blocks of at most `block`, each a pass over the corpus. Null and empty texts and stems leak nothing; stems under WINDOW words must be
    contained whole; a repeated doc_id comes out as often."""
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = [(r.item_id, r.stem) for r in items.select("item_id", "stem").where("item_id is not null").orderBy("item_id").toLocalIterator()]
    out = spark.createDataFrame([], KIND)
    for a in range(0, len(wanted), block):
        index = Index(wanted[a : a + block])
        if not index.stems:
            continue
        counts = np.zeros(len(index.keys), np.int64)
        per = spread(docs.select("text")).mapInArrow(_count(index), "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        for r in per.toLocalIterator():  # one row per gram of the block's items
            counts[r.gram] = r.n
        index.keep_rare(counts)
        found = spread(docs.select("doc_id", "text")).mapInArrow(_search(index), KIND)
        out = out.unionByName(found)
    return out
