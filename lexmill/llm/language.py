"""Problem 6: the language of each text and of each passage in mixed texts, by compression.

Per language a zstandard raw-content dictionary is built from labelled text. A unit (sentence or up to UNIT words) is encoded with every
dictionary; its size is its cost in that language. A path of least total cost with a price on switching joins units to passages;
the confidence is the share by which the second-best language is larger. Margins under MARGIN bytes are rejected (null language).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.session import bounded_batches, spread

# Languages with the names and codes that a label may use for them.
NAMES = {
    "fr": "fr fra fre french français francais französisch francés francese francês",
    "en": "en eng english anglais englisch inglés inglese inglês ingles",
    "es": "es spa spanish espagnol español espanol castellano spanisch spagnolo espanhol",
    "de": "de deu ger german allemand deutsch alemán tedesco alemão aleman",
    "it": "it ita italian italien italiano italienisch",
    "pt": "pt por portuguese portugais português portugues portugués portugiesisch portoghese",
}
CODES = {n: k for k, v in NAMES.items() for n in v.split()}
SAMPLE_ROWS, DICT_BYTES = 1500, 60_000
MOST_SAMPLES = 20_000  # rows of the table of labelled samples; larger tables are refused
UNIT, SWITCH, MARGIN, PASSAGE = 12, 14, 4, 20  # words, bytes, bytes, words
_UNIT = re.compile(r"[^.!?;:\n«»“”\"()\[\]]+(?:[.!?;:]+(?=\S)[^.!?;:\n«»“”\"()\[\]]+)*")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_TOKEN = re.compile(r"\S*\w\S*")
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>")


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def named(label: str | None) -> set[str]:
    """Languages a label names: codes, codes with region, or names, alone or listed."""
    return {CODES[x] for p in re.split(r"[^\w-]+", (label or "").lower()) for x in (p, re.split("[-_]", p)[0]) if x in CODES}


@F.pandas_udf(T.StringType())
def label_language(label: pd.Series) -> pd.Series:
    """The language of a label that names one; else null."""
    return label.map(lambda x: next(iter(names)) if len(names := named(x)) == 1 else None)


def units(text: str) -> list[tuple[int, int, int, int, str]]:
    """(begin and end of a stretch of text, first and last of its words, these words in lower case) of the units of a text; stretches
    without words belong to none. Text without tags is expected: their places are blanks."""
    out = []
    for m in _UNIT.finditer(text):
        if found := _WORD.findall(m.group()):
            n = len(found)
            if n <= UNIT:
                out.append((m.start(), m.end(), 0, n - 1, " ".join(found).lower()))
            else:
                parts = -(-n // UNIT)
                cuts = [k * n // parts for k in range(parts + 1)]
                out += [(m.start(), m.end(), a, z - 1, " ".join(found[a:z]).lower()) for a, z in zip(cuts, cuts[1:], strict=False)]
    return out


def untagged(text: str) -> str:
    return _TAG.sub(lambda m: " " * len(m.group()), text) if "<" in text else text


def _word(text: str, unit: tuple, nth: int) -> tuple[int, int]:
    """Begin and end of a word of a unit's stretch."""
    return next(islice(_WORD.finditer(text, unit[0], unit[1]), nth, None)).span()


class Model:
    """One dictionary per language, half of it without accents; texts[lang] is labelled text, of which the end counts."""

    def __init__(self, texts: dict[str, str], level: int = 3):
        self.langs = sorted(texts)
        self.coders = []
        for lang in self.langs:
            low = texts[lang].lower()
            raw = b" ".join(t.encode()[-DICT_BYTES // 2 :] for t in (low, plain(low)))
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False, write_checksum=False, write_dict_id=False))

    def costs(self, words: list[str]) -> np.ndarray:
        """Compressed sizes [unit, language]; all units go to a coder in one call."""
        if not words:
            return np.zeros((0, len(self.langs)), np.int64)
        data = [f" {w} ".encode() for w in words]
        return np.array([list(map(len, c.multi_compress_to_buffer(data))) for c in self.coders], np.int64).T

    def path(self, costs: np.ndarray) -> list[int]:
        """The languages of least total cost with SWITCH for each change. If no stretch of units gains more than SWITCH by another
        language, the path stays in the language of the least total."""
        total = costs.sum(0)
        one = int(total.argmin())
        gain = 0
        for x in (costs[:, one] - costs.min(1)).tolist():
            gain += x
            if gain > SWITCH:
                break
        else:
            return [one] * len(costs)
        k, rows = range(len(self.langs)), costs.tolist()
        best, back = rows[0], []
        for c in rows[1:]:
            low = min(k, key=best.__getitem__)
            step = [i if best[i] <= best[low] + SWITCH else low for i in k]
            best = [c[i] + (best[step[i]] if step[i] == i else best[low] + SWITCH) for i in k]
            back.append(step)
        path = [min(k, key=best.__getitem__)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def every(self, texts: list[str | None]) -> list[list[tuple[int, int, int, str | None, float]]]:
        """Of each text (start, end, words, language or None, confidence) of its passages in order; none for texts without words."""
        bare = [untagged(t) if t else "" for t in texts]
        got = [units(t) for t in bare]
        costs = self.costs([u[4] for us in got for u in us])
        out, at = [], 0
        for text, us in zip(bare, got, strict=True):
            own = costs[at : at + len(us)]
            at += len(us)
            path, found, i = self.path(own) if us else [], [], 0
            while i < len(us):
                j = i
                while j < len(us) and path[j] == path[i]:
                    j += 1
                total = own[i:j].sum(0)
                size = int(total[path[i]])
                total[path[i]] = np.iinfo(np.int64).max
                second = int(total.min()) if len(self.langs) > 1 else size
                a, z = _word(text, us[i], us[i][2])[0], _word(text, us[j - 1], us[j - 1][3])[1]
                found.append((a, z, len(_TOKEN.findall(text, a, z)), self.langs[path[i]] if second - size >= MARGIN else None, max(0.0, (second - size) / second)))
                i = j
            out.append(found)
        return out

    def passages(self, text: str | None) -> list[tuple[int, int, int, str | None, float]]:
        return self.every([text])[0]


def fit(samples: DataFrame, rows: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> dict[str, str]:
    """Labelled text per language: the samples (all of them; a fixed table), and of rows (row_id, output, lang) whose label names one
    language an equal part of sample_rows for each language, distinct row_ids in the order of their hash, as far as the label agrees with
    the dictionaries of the samples alone."""
    texts: dict[str, list[str]] = {}
    labelled = samples.select("sample_id", "lang", "text").where("text is not null and lang is not null").limit(MOST_SAMPLES + 1).collect()
    if len(labelled) > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} labelled samples")
    for r in sorted(labelled, key=lambda r: (r.sample_id is None, r.sample_id or 0, r.text)):
        texts.setdefault(r.lang, []).append(r.text)
    base = {k: " ".join(v) for k, v in texts.items()}
    if rows is None or not base:
        return base
    model = Model(base)
    known = rows.select("row_id", "output", label_language(F.col("lang")).alias("lang")).where(F.col("lang").isin(list(base)))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("row_id").alias("n")).collect()}
    quota = max(1, sample_rows // len(base))
    rank = F.pmod(F.xxhash64("row_id", F.lit(5)), F.lit(1_000_000))
    low = F.lit(False)
    for lang, n in counts.items():  # half as many again, as the counts are estimates and the hash is uneven
        low = low | ((F.col("lang") == lang) & (rank < int(min(1_000_000, 1_500_000 * quota / n + 1))))
    some = known.where(low).groupBy("lang", "row_id").agg(F.min(F.substring("output", 1, 4000)).alias("output"), F.min(rank).alias("rank"))
    taken: dict[str, int] = {}
    more: dict[str, list[str]] = {}
    for r in sorted(some.collect(), key=lambda r: (r.rank, r.row_id is None, r.row_id or 0)):
        taken[r.lang] = taken.get(r.lang, 0) + 1
        if taken[r.lang] <= quota:
            got = model.passages(r.output)
            if len(got) == 1 and got[0][3] == r.lang and got[0][2] >= 15:
                more.setdefault(r.lang, []).append((r.row_id, " ".join(u[4] for u in units(untagged(r.output)))))
    return {k: " ".join([t for _, t in sorted(more.get(k, []))] + [v]) for k, v in base.items()}


def _segments(texts: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(texts)
        for b in batches:
            out = []
            keys, labels, texts_ = (b.column(i).to_pylist() for i in range(3))
            for key, label, got in zip(keys, labels, model.every(texts_), strict=True):
                names = sorted(named(label))
                total = sum(p[2] for p in got)
                out += [(key, i, a, z, n, n / total, lang, sure, names) for i, (a, z, n, lang, sure) in enumerate(got)] or [(key, 0, None, None, 0, 0.0, None, 0.0, names)]
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.float64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["row_id", "passage", "start_pos", "end_pos", "words", "share", "lang", "confidence", "label_langs"])

    return run


def passages(rows: DataFrame, samples: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """row_id, passage, start_pos, end_pos, words, share of the text's words, lang (null where the margin is narrow), confidence,
    label_langs (what the label names). rows: row_id, output, lang; samples: sample_id, lang, text.

    One passage for a text in one language; texts without words (null, blank, numbers) give one row without language. Repeated rows
    come out as often. No shuffle; the dictionaries go out with the function and are at most DICT_BYTES per language."""
    bounded_batches(rows.sparkSession)
    texts = {k: v.encode()[-DICT_BYTES:].decode(errors="ignore") for k, v in fit(samples, rows, sample_rows).items()}
    kind = "row_id bigint, passage int, start_pos bigint, end_pos bigint, words bigint, share double, lang string, confidence double, label_langs array<string>"
    return spread(rows.select("row_id", "lang", "output")).mapInArrow(_segments(texts), kind)


def mislabelled(found: DataFrame, least: int = PASSAGE) -> DataFrame:
    """row_id, lang: the whole output, or at least `least` words on end, is in this language and the label does not name it."""
    whole = F.col("share") >= 0.999
    return found.where(F.col("lang").isNotNull() & (whole | (F.col("words") >= least)) & ~F.array_contains("label_langs", F.col("lang"))).select("row_id", "lang").distinct()
