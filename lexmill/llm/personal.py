"""Problem 9: personal information in free text, by a linear-chain conditional random field.

Features are shapes and word classes of a token and of its neighbours up to three places away, and the classes of neighbours taken
together; words themselves are no features unless they belong to a class (a title, a label, a street word), so that the model cannot
learn sentences by heart. All are functions of one token type or of two classes, so a worker keeps one row of scores per type and the
score of a position is the sum of seven rows and two entries of class tables. A stretch on which no token can raise the score above the
all-outside path (a bound on emissions and transitions) needs no decoding and is outside as a whole; the others are decoded by Viterbi
in numpy batches. Weights are fitted on the driver by Adam on the exact log-likelihood of the small labelled table in personal_table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm import personal_table as table
from lexmill.llm.personal_words import CLASS_OF, CLASSES, GIVEN
from lexmill.session import bounded_batches, spread

KINDS = table.KINDS
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
K = len(TAGS)
FAR = 3
ROLES = (-3, -2, -1, 0, 1, 2, 3)
_SEP = r"<>\"{}()\[\],;:!?«»“”…="
TOKEN = re.compile(rf"[{_SEP}]|[^\W\d_]{{1,2}}['’]|[^\s{_SEP}.]+(?:\.+[^\s{_SEP}.]+)*|\.")
CACHE = 200_000
CLEAN_ROWS = 500
_VOWEL = re.compile("[aeiouyàâäáãéèêëíìîïóòôöõúùûüœæ]")
# How compounds that name a street end.
_STREET = ("straße", "strasse", "gasse", "weg", "allee", "platz", "damm", "ufer", "str")
_MARKS = "<>\"{}()[],;:!?«»“”…=.-–—/|@&+*#%'’"


def shape(word: str) -> str:
    """X capital, Xx capitalised, XX capitals, x lower case, d and the length for digits, other characters themselves."""
    out, i = [], 0
    while i < len(word) and len(out) < 14:
        c, j = word[i], i
        if c.isdigit():
            while j < len(word) and word[j].isdigit():
                j += 1
            out.append(f"d{j - i}")
        elif c.isalpha():
            while j < len(word) and word[j].isalpha():
                j += 1
            run = word[i:j]
            out.append("x" if run.islower() else ("X" if len(run) == 1 else "XX") if run.isupper() else "Xx" if run[0].isupper() and run[1:].islower() else "xX")
        else:
            j += 1
            out.append(c)
        i = j
    return "".join(out)


def word_class(word: str) -> str | None:
    """The class of a word, with ^ where it begins with a capital; given names are a class too."""
    low = word.lower()
    c = "given" if low in GIVEN or ("-" in low and low.split("-")[0] in GIVEN) else CLASS_OF.get(low) or CLASS_OF.get(low.replace(".", ""))
    return c and c + "^" * word[0].isupper()


def coarse(word: str) -> str:
    """One class for any token: word class, mark, count of digits or kind of letters."""
    if len(word) == 1 and word in _MARKS:
        return word
    if word.isdigit():
        return "d2z" if len(word) == 2 and word[0] == "0" else f"d{min(len(word), 6) if len(word) < 9 else 9}"
    if "@" in word:
        return "@x"
    if c := word_class(word):
        return c
    if any(x.isdigit() for x in word):
        return "dx" if any(x.isalpha() for x in word) else "d-"
    s = shape(word)
    return s if s in ("X", "XX", "Xx", "x", "xX") else "X-" if word[0].isupper() else "x-" if word[0].isalpha() else "other"


COARSE = ("", *_MARKS, *(f"d{n}" for n in (1, 2, 3, 4, 5, 6, 9)), "d2z", "@x", "dx", "d-", "X", "XX", "Xx", "x", "xX", "X-", "x-", "other", *(c + u for c in ("given", *CLASSES) for u in ("", "^")))
_PLACE = {c: i for i, c in enumerate(COARSE)}


def features(word: str) -> list[str]:
    low, s = word.lower(), shape(word)
    digits = sum(c.isdigit() for c in word)
    out = ["1", "s=" + s, "c=" + re.sub(r"d\d+", "d", s), "k=" + coarse(word)]
    if c := word_class(word):
        out += ["k=" + c.rstrip("^"), "w=" + low]
    if digits:
        out += [f"n={min(digits, 16)}", "all" if digits == len(word) else "mixed"]
        if word[0] in "0123+(":
            out.append(f"lead={word[:2] if word[0] == '0' else word[0]}{min(digits, 16)}")
    if word[0].isalpha():
        out.append(f"l={min(len(word), 6 if s == 'XX' else 4)}")
        if s[0] == "X" and not _VOWEL.search(low):
            out.append("consonants")
        if low.endswith(_STREET):
            out.append("street")
    return out


def _kind(word: str) -> tuple[tuple[str, ...], str]:
    return tuple(features(word)), coarse(word)


class Crf:
    """vocabulary: feature -> row; weight[row, role, tag]; step[tag, tag], first[tag], last[tag]; before and after [class pair, tag]: of a
    token with the one before, and with the one after it."""

    def __init__(self, vocabulary: dict[str, int], weight: np.ndarray, step: np.ndarray, first: np.ndarray, last: np.ndarray, before: np.ndarray, after: np.ndarray):
        self.vocabulary, self.weight, self.step, self.first, self.last, self.before, self.after = vocabulary, weight, step, first, last, before, after
        # Most that a token with tag k can add over the outside path by its entry, and any exit after it.
        enter = np.maximum(step.max(0), first) - min(step[0, 0], first[0])
        leave = max(0.0, float((step[1:, 0] - step[0, 0]).max()), float((last[1:] - last[0]).max()))
        self.slack = (enter + leave).astype(np.float32)

    def row(self, word: str) -> np.ndarray:
        at = [self.vocabulary[f] for f in features(word) if f in self.vocabulary]
        return self.weight[at].sum(0) if at else np.zeros(self.weight.shape[1:], np.float32)

    def scores(self, ids: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Scores [place, tag] of token numbers ids, of which 0 is none; rows[role, number, tag], classes[number]."""
        far = [0] * FAR
        wide = np.concatenate([far, ids, far])
        n, c = len(ids), classes[wide]
        e = sum(rows[j].take(wide[FAR + d : FAR + d + n], 0) for j, d in enumerate(ROLES))
        e += self.before.take(c[FAR - 1 : FAR + n - 1] * len(COARSE) + c[FAR : FAR + n], 0)
        e += self.after.take(c[FAR : FAR + n] * len(COARSE) + c[FAR + 1 : FAR + n + 1], 0)
        return e


def tokens(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in TOKEN.finditer(text)]


class Gather:
    """Sums rows by an index that stays the same over many calls."""

    def __init__(self, index: np.ndarray, size: int):
        self.order = np.argsort(index, kind="stable")
        self.at, self.first = np.unique(index[self.order], return_index=True)
        self.size = size

    def sum(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, rows.shape[1]), rows.dtype)
        out[self.at] = np.add.reduceat(rows.take(self.order, 0), self.first)
        return out


@lru_cache(maxsize=2)
def train(clean: tuple[str, ...] = (), seed: int = 1, rounds: int = 45, rate: float = 0.12, decay: float = 2e-5) -> Crf:
    """Fit on the labelled table and on clean lines, which hold no personal information."""
    rows = table.table(seed) + [(t, []) for t in clean]
    seqs, tags, kinds = [], [], {}
    for text, spans in rows:
        t = tokens(text)
        y = np.zeros(len(t), np.int64)
        for a, z, kind in spans:
            inside = [i for i, (b, e) in enumerate(t) if b < z and e > a]
            base = 1 + 2 * KINDS.index(kind)
            for n, i in enumerate(inside):
                y[i] = base + (n > 0)
        seqs.append([kinds[w] if (w := text[a:z]) in kinds else kinds.setdefault(w, _kind(w)) for a, z in t])
        tags.append(y)
    # Words with the same features are one type: most words are, as a feature is a shape or a class.
    types = {w: i for i, w in enumerate(sorted({w for s in seqs for w in s}))}
    feats = [fs for fs, _ in types]
    seen: dict[str, int] = {}
    for s in seqs:
        for f in {f for fs, _ in set(s) for f in fs}:
            seen[f] = seen.get(f, 0) + 1
    vocabulary = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3))}
    pairs = np.array([(t, vocabulary[f]) for t, fs in enumerate(feats) for f in fs if f in vocabulary])
    # Tokens lie packed by place, longest sequences first: place t of the sequences that reach it is one block.
    order = sorted((i for i in range(len(seqs)) if seqs[i]), key=lambda i: -len(seqs[i]))
    size = np.array([len(seqs[i]) for i in order])
    n, width = len(order), int(size[0])
    reach = [int((size > t).sum()) for t in range(width)]
    off = np.cumsum([0, *reach])
    blocks = [slice(off[t], off[t + 1]) for t in range(width)]
    before = [slice(off[t - 1], off[t - 1] + reach[t]) for t in range(width)]
    pad = len(types)
    x = np.full((n, width + 2 * FAR), pad, np.int64)
    y = np.zeros(off[-1], np.int64)
    for r, i in enumerate(order):
        x[r, FAR : FAR + size[r]] = [types[w] for w in seqs[i]]
        y[off[: size[r]] + r] = tags[i]
    near = [np.concatenate([x[: reach[t], FAR + t + d] for t in range(width)]) for d in ROLES]
    end = off[size - 1] + np.arange(n)
    classes = np.array([*(_PLACE[c] for _, c in types), 0])
    pair = [classes[near[a]] * len(COARSE) + classes[near[a + 1]] for a in (FAR - 1, FAR)]
    real = np.float32
    params = [np.zeros((len(vocabulary), len(ROLES), K), real), np.zeros((K, K), real), np.zeros(K, real), np.zeros(K, real)]
    params += [np.zeros((len(COARSE) ** 2, K), real) for _ in pair]
    for k in KINDS:  # an inside tag follows its own kind only
        i = TAGS.index(f"I-{k}")
        params[1][:, i] = params[2][i] = -8.0
        params[1][[i - 1, i], i] = 0.0
    moment, scale = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gold = np.eye(K, dtype=real)[y]
    step_gold = sum(gold[before[t]].T @ gold[blocks[t]] for t in range(1, width))
    by_type = [Gather(at, len(types) + 1) for at in near]
    by_class = [Gather(at, len(COARSE) ** 2) for at in pair]
    by_pair, by_feature = Gather(pairs[:, 0], len(types) + 1), Gather(pairs[:, 1], len(vocabulary))
    alpha, beta, norm = np.zeros((off[-1], K), real), np.zeros((off[-1], K), real), np.ones((off[-1], 1), real)
    for it in range(1, rounds + 1):
        w, step, first, last, *joint = params
        types_score = by_pair.sum(w[pairs[:, 1]].reshape(len(pairs), -1)).reshape(-1, len(ROLES), K)
        e = sum(types_score[at, j] for j, at in enumerate(near)) + sum(v[at] for v, at in zip(joint, pair, strict=True))
        e = np.exp(e - e.max(1, keepdims=True))
        go, out = np.exp(step), np.exp(last)
        for t, own in enumerate(blocks):
            a = e[own] * (alpha[before[t]] @ go if t else np.exp(first))
            norm[own] = a.sum(1, keepdims=True)
            alpha[own] = a / norm[own]
        beta[end] = out / (alpha[end] @ out)[:, None]
        g_step = step_gold.copy()
        for t in range(width - 1, 0, -1):
            ahead = e[blocks[t]] * beta[blocks[t]] / norm[blocks[t]]
            beta[before[t]] = ahead @ go.T
            g_step -= (alpha[before[t]].T @ ahead) * go
        diff = gold - alpha * beta
        g_types = np.stack([g.sum(diff) for g in by_type], 1)
        g_w = by_feature.sum(g_types[pairs[:, 0]].reshape(len(pairs), -1)).reshape(w.shape)
        grads = [g_w, g_step, diff[blocks[0]].sum(0), diff[end].sum(0), *(g.sum(diff) for g in by_class)]
        for p, g, a, b in zip(params, grads, moment, scale, strict=True):
            g = g / n - decay * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += (rate * (a / (1 - 0.9**it)) / (np.sqrt(b / (1 - 0.99**it)) + 1e-8)).astype(real)
    return Crf(vocabulary, *params)


def viterbi(crf: Crf, e: np.ndarray, begin: np.ndarray, size: np.ndarray, head: np.ndarray, tail: np.ndarray, batch: int = 1024) -> np.ndarray:
    """Best tags of the sequences e[begin : begin + size], laid end to end; head and tail are the scores [sequence, tag] of beginning
    and ending with a tag. Sequences of similar length are decoded together."""
    out = np.zeros(int(size.sum()), np.int8)
    at = np.cumsum(size) - size
    order = np.argsort(-size, kind="stable")
    a = 0
    while a < len(order):
        own = order[a : a + max(1, min(batch, 200_000 // int(size[order[a]])))]
        a += len(own)
        n, b = size[own], begin[own]
        back = np.zeros((int(n[0]), len(own), K), np.int8)
        score = head[own] + e[b]
        for t in range(1, int(n[0])):
            m = int(np.searchsorted(-n, -t))
            way = score[:m, :, None] + crf.step
            back[t, :m] = way.argmax(1)
            score[:m] = way.max(1) + e[b[:m] + t]
        tag = (score + tail[own]).argmax(1)
        for t in range(int(n[0]) - 1, -1, -1):
            m = int(np.searchsorted(-n, -t))
            out[at[own[:m]] + t] = tag[:m]
            if t:
                tag[:m] = back[t, np.arange(m), tag[:m]]
    return out


_AT = re.compile(r"\S ?@ ?\S|(?:[\[(]at[\])]|\bat\b|\barobas\w*).*(?:\.\w{2,}|\bdot\b|\bpoint\b)", re.I)
_EDGE = " ,;:.\"'<>"
LEAST_ID = 8  # letters and digits of an identity number


def valid(kind: str, text: str, before: str = "") -> bool:
    """The check that follows decoding: a span must have what its kind cannot do without. before is the line up to the span; a name of
    one word that is no known given name needs a form of address or a mark before it, or begins the line."""
    if kind == "email":
        return bool(_AT.search(text))
    digits = "".join(c for c in text if c.isdigit())
    if kind == "phone":
        return len(digits) >= 8 and not (len(digits) == 13 and digits[:3] in ("978", "979"))  # a book number
    if kind == "id_number":
        return len(digits) >= 5 and sum(c.isalnum() for c in text) >= LEAST_ID
    if kind == "address":
        return bool(digits) and any(w[0].isupper() or CLASS_OF.get(w.lower()) == "street" for w in re.findall(r"[^\W\d_]+", text))
    words = re.split(r"[\s,]+", text.strip())
    known = words[0].lower().split("-")[0] in GIVEN
    if len(words) == 1 and not known:
        last = before.split()[-2:]
        if last and last[-1][-1] not in ":;,(|>\"-" and not any((word_class(w.strip("(:;,.")) or "").startswith(("title", "kin")) for w in last if w.strip("(:;,.")):
            return False
    capital = any(w[0].isupper() and not re.match(r"\w+['’][a-zà-ÿ]", w) for w in words if w)
    return sum(c.isalpha() for c in text) >= 2 and (capital or known) and CLASS_OF.get(words[-1]) != "particle"


_LEAD = re.compile(r"(\w+(?:\.\w+)*)\.? +(?=\S)")
_ONE, _TWO = (re.compile(rf"(?:^|[\s:;,(>])((?:[^\W\d_]{{2,4}} +){{{n}}})$") for n in (1, 2))


def bounded(line: str, a: int, z: int) -> int:
    """Where a name begins: after a form of address, and with the particle before it, if that is in capitals as the name is or follows a
    form of address."""
    while (m := _LEAD.match(line, a, z)) and (word_class(m.group(1)) or "") == "title^":
        a = m.end()
    for m in (_TWO.search(line[:a]), _ONE.search(line[:a])):
        if m and all(CLASS_OF.get(p.lower()) == "particle" for p in m.group(1).split()) and m.group(1).lower().split()[0] not in ("la", "le", "les", "el"):
            head = line[: m.start(1)].split()
            titled = bool(head) and (word_class(head[-1].strip(".,(") or "-") or "").startswith("title")
            return m.start(1) if titled or (m.group(1).isupper() and line[a : a + 2].isupper()) else a
    return a


def joined(kind: str, one: str, between: str, two: str) -> bool:
    """Whether two neighbouring spans are one: a street and the post code on the next line, a surname and the given name after its
    comma, a particle and its name."""
    if kind == "address":
        return not between.strip(" \t\r\n,-") and bool(re.match(r"\d{4,5}\b", two))
    return kind == "name" and len(between) < 3 and ((between.strip() == "," and " " not in one and " " not in two and two.lower() in GIVEN) or (between == " " and one.split()[-1].islower() and len(one.split()[-1]) < 4))


class Tagger(dict):
    """White-space chunk -> numbers of its token types, each with its score rows; forgotten beyond CACHE types. Finds spans."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((len(ROLES), 1024, K), np.float32)
        self.classes = np.zeros(1024, np.int64)

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        out = []
        for word in TOKEN.findall(chunk):
            if not (n := self.rows.get(word)):
                n = self.rows[word] = len(self.rows) + 1
                if n == self.scores.shape[1]:
                    self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)], 1)
                    self.classes = np.concatenate([self.classes, np.zeros_like(self.classes)])
                self.scores[:, n], self.classes[n] = self.crf.row(word), _PLACE[coarse(word)]
            out.append(n)
        self[chunk] = got = tuple(out)
        return got

    def _islands(self, ids: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and sizes of the stretches outside of which no best path leaves O: a stretch of other tags must gain on the outside
        path, and its gain is at most the sum of the bounds of its tokens."""
        gain = ((e[:, 1:] - e[:, :1]) + self.crf.slack[1:]).max(1).astype(np.float64)
        gain[ids == 0] = -1e4
        total = np.concatenate([[0.0], np.cumsum(gain)])
        forth = total[1:] - np.minimum.accumulate(total[:-1])
        back = np.maximum.accumulate(total[:0:-1])[::-1] - total[:-1]
        hot = np.concatenate([[False], (forth + back - gain > 0) & (ids > 0), [False]])
        edge = np.flatnonzero(hot[1:] != hot[:-1])
        return edge[::2], edge[1::2] - edge[::2]

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) of each text in order."""
        if len(self.rows) > CACHE or len(self) > 2 * CACHE:
            self._reset()
        look, flat = self.__getitem__, [0] * FAR
        lines: list[tuple[int, int, str]] = []  # text, offset in it, line
        begin: list[int] = []
        for n, text in enumerate(texts):
            if text:
                at = 0
                for line in text.split("\n"):
                    if chunks := line.split():
                        lines.append((n, at, line))
                        begin.append(len(flat))
                        flat.extend(chain.from_iterable(map(look, chunks)))
                        flat += [0] * FAR
                    at += len(line) + 1
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        if not lines:
            return out
        ids = np.array(flat, np.int32)
        e = self.crf.scores(ids, self.scores, self.classes)
        first, size = self._islands(ids, e)
        opens, closes = ids[first - 1] == 0, ids[first + size] == 0
        crf = self.crf
        tags = viterbi(crf, e, first, size, np.where(opens[:, None], crf.first, crf.step[0]), np.where(closes[:, None], crf.last, crf.step[:, 0]))
        places = np.repeat(first - np.cumsum(size) + size, size) + np.arange(len(tags))
        some = np.flatnonzero(tags)
        line_of = np.searchsorted(np.array(begin), places[some], "right") - 1
        k = 0
        while k < len(some):
            h = int(line_of[k])
            n, at, line = lines[h]
            place = [(c.start() + m.start(), c.start() + m.end()) for c in re.finditer(r"\S+", line) for m in TOKEN.finditer(c.group())]
            while k < len(some) and line_of[k] == h:
                i = int(places[some[k]]) - begin[h]
                kind = (int(tags[some[k]]) - 1) // 2
                j = i
                k += 1
                while k < len(some) and line_of[k] == h and places[some[k]] - begin[h] == j + 1 and tags[some[k]] == 2 * kind + 2:
                    j, k = j + 1, k + 1
                a, z = place[i][0], place[j][1]
                a, z = a + len(line[a:z]) - len(line[a:z].lstrip(_EDGE)), z - len(line[a:z]) + len(line[a:z].rstrip(_EDGE))
                if KINDS[kind] == "name":
                    a = bounded(line, a, z)
                last = out[n][-1] if out[n] else None
                if last and last[2] == KINDS[kind] and joined(KINDS[kind], texts[n][last[0] : last[1]], texts[n][last[1] : at + a], line[a:z]):
                    out[n][-1] = (last[0], at + z, last[2])
                elif valid(KINDS[kind], line[a:z], line[:a]):
                    out[n].append((at + a, at + z, KINDS[kind]))
        return out


def mask(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS], [NAME] in the place of spans."""
    if not text or not spans:
        return text
    out, at = [], 0
    for a, z, kind in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = z
    return "".join([*out, text[at:]])


def _find(crf: Crf, masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(crf)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            found = tagger.spans(texts)
            if masked:
                text = [mask(t, s) for t, s in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "text": pa.array(text, pa.string()), "n_found": pa.array([len(s) for s in found], pa.int32())})
            else:
                out = [(k, kind, a, z, t[a:z]) for k, t, s in zip(keys, texts, found, strict=True) for a, z, kind in s]
                if out:
                    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "kind", "start_pos", "end_pos", "found"])

    return run


def clean_lines(*texts: DataFrame, limit: int = CLEAN_ROWS) -> tuple[str, ...]:
    """Lines of the column text of small tables known to hold no personal information, for training; at most limit rows of each."""
    rows = [r.text for t in texts for r in t.select("text").where("text is not null").orderBy("text").limit(limit).collect()]
    return tuple(x for t in rows for x in t.split("\n") if x.strip())


def find(docs: DataFrame, clean: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kind, start_pos, end_pos (code points), found: one row per span; no shuffle. docs: doc_id, text; other columns are
    ignored. Null and empty texts give none; a repeated doc_id gives its spans as often."""
    bounded_batches(docs.sparkSession)
    return spread(docs.select("doc_id", "text")).mapInArrow(_find(train(clean), False), "doc_id bigint, kind string, start_pos bigint, end_pos bigint, found string")


def redact(docs: DataFrame, clean: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text with typed placeholders, n_found. Null text stays null."""
    bounded_batches(docs.sparkSession)
    return spread(docs.select("doc_id", "text")).mapInArrow(_find(train(clean), True), "doc_id bigint, text string, n_found int")
