"""Language identification of mixed text: script ranges narrow the candidates, Viterbi over word scores labels the spans.

A word's score in a language is the sum of the log-probabilities of its letters' trigrams, hashed into a table of fixed size. Languages
that hardly use the word's script are ruled out. Switching the language between words costs a penalty, and the best path labels
every word; texts advance word by word together, so the search is vectorised over texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed trigrams of a language.
SLOTS = 1 << 16
#: First and last code points by script (fixed values); letters outside them count as one more script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
#: Characters scored at once, and characters of texts that go through the search together.
SCORE_CHARS, SEARCH_CHARS = 1 << 19, 1 << 22


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the script's number (0: no letter), and the lower-case letter."""
    script, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    other = len(SCRIPTS) + 1
    for cp in range(0x41, 0x33480):
        c = chr(cp)
        if c.isalpha():
            script[cp] = other
            low = c.lower()
            lower[cp] = ord(low) if len(low) == 1 else cp
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            part = script[a : b + 1]
            part[part > 0] = k
    return script, lower


def _letters(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: trigram slot and script of each letter, and the letters' places."""
    script, lower = _tables()
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = script[cp]
    c = np.where(kind > 0, lower[cp], 0).astype(np.uint64)
    c = np.concatenate([[np.uint64(0)], c, [np.uint64(0)]])
    at = np.flatnonzero(kind)
    with np.errstate(over="ignore"):
        h = c[at] * np.uint64(0x9E3779B97F4A7C15) + c[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[at + 2] * np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(48)).astype(np.int32), kind[at], at


def _counts(langs: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = SLOTS + len(SCRIPTS) + 2
        counts = np.zeros((len(langs), n), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                slots, scripts, _ = _letters(text.as_py() or "")
                counts[langs.index(lang)] += np.bincount(np.concatenate([slots, SLOTS + scripts.astype(np.int32)]), minlength=n)
        lang, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[lang, slot])], ["lang", "slot", "n"])

    return work


class Model:
    """Log-probabilities by slot and language, and which languages use a script."""

    def __init__(self, langs: list[str], counts: np.ndarray, least_share: float):
        self.langs = langs
        grams, scripts = counts[:, :SLOTS].astype(np.float64), counts[:, SLOTS:].astype(np.float64)
        self.scores = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * SLOTS)).T.astype(np.float32).copy()
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        allowed = share >= least_share
        allowed[:, ~allowed.any(axis=0)] = True
        self.ruled_out = np.where(allowed, 0, -1e6).T.astype(np.float32).copy()


def train(df: DataFrame, text: Column, lang: Column, key: Column | None = None, rows_a_language: int = 4000, least_share: float = 0.005) -> Model:
    """Fits on a sample of about ``rows_a_language`` rows of each language, chosen by a hash of the key, or else of the text."""
    rows = df.select(text.cast("string").alias("text"), lang.cast("string").alias("lang"), F.xxhash64(text if key is None else key).alias("place")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, SLOTS + len(SCRIPTS) + 2)), least_share)
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, rows_a_language / sizes[k])))])[F.col("lang")]
    sample = rows.where(F.pmod("place", F.lit(1_000_000)) < rate * 1_000_000).select("text", "lang")
    found = sample.mapInArrow(_counts(langs), "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), SLOTS + len(SCRIPTS) + 2))  # languages times slots, whatever the input
    counts[found.lang, found.slot] = found.n
    return Model(langs, counts, least_share)


def word_scores(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word: scores by language, letters, start and end in its text; and the texts' bounds in words."""
    scores, sizes, starts, ends, bounds = [], [], [], [], [0]
    k = 0
    while k < len(texts):
        n, first = 0, k
        while k < len(texts) and (n == 0 or n + len(texts[k]) < SCORE_CHARS):
            n += len(texts[k]) + 1
            k += 1
        slots, scripts, at = _letters("\n".join(texts[first:k]))
        offset = np.cumsum([0, *(len(t) + 1 for t in texts[first:k])])
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(scripts) != 0)])) if len(at) else np.zeros(0, np.int64)
        begin = at[new] if len(at) else at
        last = at[np.concatenate([new[1:] - 1, [len(at) - 1]])] + 1 if len(at) else at
        owner = np.searchsorted(offset, begin, "right") - 1
        bounds += (bounds[-1] + np.searchsorted(begin, offset[1:])).tolist()
        if len(at):
            parts = [np.add.reduceat(model.scores[slots[a:b]], new[i:j] - a, axis=0) for i, j, a, b in _spans(new, len(at))]
            scores.append(np.concatenate(parts) + model.ruled_out[scripts[new]])
            sizes.append(last - begin)
            starts.append(begin - offset[owner])
            ends.append(last - offset[owner])
    cat = lambda x, shape: np.concatenate(x) if x else np.zeros(shape)
    return cat(scores, (0, len(model.langs))), cat(sizes, 0), cat(starts, 0), cat(ends, 0), np.array(bounds)


def _spans(new: np.ndarray, n: int, most: int = 1 << 18) -> Iterator[tuple[int, int, int, int]]:
    """Runs of whole words of about ``most`` letters: numbers of words and of letters."""
    i = 0
    while i < len(new):
        j = max(i + 1, int(np.searchsorted(new, new[i] + most)))
        yield i, j, new[i], new[j] if j < len(new) else n
        i = j


def best_paths(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on each text's best path. All texts advance together, the longest first."""
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    first, size = bounds[order], size[order]
    longest = int(size[0]) if len(size) else 0
    label, came = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int32), np.zeros(scores.shape, bool)
    best_before = np.zeros(len(scores), label.dtype)
    active = np.searchsorted(-size, -np.arange(longest), "left")  # texts of more than t words
    now = scores[first[: active[0]]] if longest else scores[:0]
    last = np.zeros(len(order), np.int64)
    for t in range(longest):
        k = active[t]
        if t:
            now = now[:k]
            top = now.argmax(axis=1)
            away = now[np.arange(k), top] - penalty
            at = first[:k] + t
            stay = now >= away[:, None]
            came[at], best_before[at] = stay, top
            now = np.where(stay, now, away[:, None]) + scores[at]
        ending = slice(active[t + 1] if t + 1 < longest else 0, k)
        last[ending] = now[ending].argmax(axis=1)
    for t in reversed(range(longest)):
        k = active[t]
        at = first[:k] + t
        label[at] = last[:k]
        if t:
            last[:k] = np.where(came[at, last[:k]], last[:k], best_before[at])
    return label


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _predict(model, text_col: str, penalty: float, with_spans: bool):
    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            first, n = 0, 0
            for k, t in enumerate(texts):
                if n and n + len(t) > SEARCH_CHARS:
                    yield batch.slice(first, k - first), texts[first:k]
                    first, n = k, 0
                n += len(t)
            yield batch.slice(first), texts[first:]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch, texts in groups(batches):
            pred, score, spans = ["und"] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
            if m.langs and texts:
                scores, sizes, starts, ends, bounds = word_scores(texts, m)
                label = best_paths(scores, bounds, penalty)
                share = np.zeros((len(texts), len(m.langs)))
                np.add.at(share, (np.repeat(np.arange(len(texts)), np.diff(bounds)), label), sizes)
                total = share.sum(axis=1)
                best = share.argmax(axis=1)
                score = np.where(total > 0, share[np.arange(len(texts)), best] / np.maximum(1, total), 0.0)
                pred = [m.langs[b] if n else "und" for b, n in zip(best, total)]
                if with_spans:
                    for i in range(len(texts)):
                        a, b = bounds[i], bounds[i + 1]
                        new = np.flatnonzero(np.concatenate([[True], label[a + 1 : b] != label[a : b - 1]])) if b > a else []
                        spans[i] = [{"start": int(starts[a + x]), "end": int(ends[(a + new[k + 1] if k + 1 < len(new) else b) - 1]), "lang": m.langs[label[a + x]]} for k, x in enumerate(new)]
            arrays = [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            names = [*batch.schema.names, "lang_pred", "lang_score"]
            if with_spans:
                arrays, names = [*arrays, pa.array(spans, _SPAN)], [*names, "lang_spans"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return work


def identify(df: DataFrame, model: Model, text_col: str = "text", penalty: float = 12.0, with_spans: bool = False) -> DataFrame:
    """``df`` with ``lang_pred`` (``und`` for a text that is null or has no letters), ``lang_score`` (the share of letters in spans of that
    language) and, if asked for, ``lang_spans`` (start and end in code points, language).

    Of equal shares the first language by name wins. Other columns pass through (columns of the new names are replaced); repeated rows are
    judged alike, and without any training row everything is ``und`` with a score of 0.
    """
    df = df.drop("lang_pred", "lang_score", *["lang_spans"] * with_spans)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    more = ", lang_spans array<struct<start:bigint,end:bigint,lang:string>>" if with_spans else ""
    return df.mapInArrow(_predict(df.sparkSession.sparkContext.broadcast(model), text_col, penalty, with_spans), f"{fields}, lang_pred string, lang_score double{more}")


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
