"""Personal data: fixed forms, and a skip-chain conditional random field for what they miss.

Tokens that hold a digit or an ``@`` are the nodes of a document's field. Neighbouring tokens share a chain potential, and tokens that repeat, or
agree in their digits, share a skip potential wherever they stand. Tokens of a fixed form are observed: their label is given, and the first such
mention of an entity shares a skip potential with every other one, so an entity written once in a clear form lends its label to all its
mentions, however many and however far. Loopy belief propagation runs over all documents of a batch at once until the messages settle. The
weights are fitted here, factor by factor, on a bounded sample that the fixed forms label. Tokens whose marginal is high add spans; those of the
fixed forms always stay.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # the last: no personal data
OTHER = len(KINDS)

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, from each ``@`` outwards, in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed forms, by start and then kind."""
    if not _ANY.search(text):
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


#: Features of a token; each is a small count, cut off.
N_FEATURES = 40
#: The potential, in nats, of a label that a fixed form gives: more than any number of mentions can outweigh.
OBSERVED = 1e6


def features(token: str) -> list[int]:
    """Active features: shape facts of a token and of its digits."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    dots = token.count(".")
    out = [0, 1 + min(digits, 20)]
    for k, fact in enumerate(("@" in token, token.startswith("+"), "(" in token, "-" in token, digits == 3 and dots == 0, dots == 3, dots > 3, letters == 0, letters > 0 and digits > 0, digits * 2 >= len(token), "=" in token, "@" in token and "." in token[token.find("@") :], len(digits_of(token)) >= 14 and luhn(digits_of(token)), letters > digits)):
        if fact:
            out.append(22 + k)
    return out


def digits_of(token: str) -> str:
    return _NOT_DIGIT.sub("", token)


class Field:
    """Nodes and edges of the fields of many texts: tokens, and pairs of them by kind of edge: 0 chain, 1 skip to the next mention, 2 skip from a clear one."""

    def __init__(self, texts: list[str], known: list[list[tuple[int, int, int]]] | None = None):
        """``known`` holds the texts' fixed forms; without it they are found here."""
        self.starts, self.ends, self.owner, self.rows, self.edges = [], [], [], [], []
        #: Per node the kind of the fixed form that covers most of it, OTHER for none.
        self.label: list[int] = []
        for k, text in enumerate(texts):
            if not _ANY.search(text):
                continue
            spans = base_spans(text) if known is None else known[k]
            mentions: dict[str, list[int]] = {}
            last, open_ = None, 0
            for m in _TOKEN.finditer(text):
                token, node = m[0], len(self.starts)
                while open_ < len(spans) and spans[open_][2] <= m.start():
                    open_ += 1
                self.starts.append(m.start())
                self.ends.append(m.end())
                self.owner.append(k)
                self.rows.append(features(token))
                self.label.append(_covering(spans, open_, m.start(), m.end()))
                if last is not None and m.start() - last <= 2:
                    self.edges.append((node - 1, node, 0))
                last = m.end()
                number = digits_of(token)
                name = "d" + number[-10:] if len(number) >= 7 else "t" + token.lower().strip(".,;:!?()\"'")
                mentions.setdefault(name, []).append(node)
            # The mentions of a name hang on its first clear one; without one they form a path. Either way their edges are as many as they are.
            for nodes in mentions.values():
                clear = next((i for i in nodes if self.label[i] != OTHER), None) if len(nodes) > 1 else None
                self.edges += zip(nodes, nodes[1:], itertools.repeat(1)) if clear is None else [(clear, i, 2) for i in nodes if self.label[i] == OTHER]
        self.n = len(self.starts)

    def unary(self, weights: np.ndarray) -> np.ndarray:
        at = np.repeat(np.arange(self.n), [len(r) for r in self.rows])
        out = np.zeros((self.n, LABELS))
        np.add.at(out, at, weights[np.concatenate(self.rows)] if self.n else weights[:0])
        return out

    def observed(self) -> np.ndarray:
        """A large potential for the labels that the fixed forms give."""
        label = np.array(self.label, np.int64)
        return OBSERVED * (np.eye(LABELS)[label] * (label != OTHER)[:, None]) if self.n else np.zeros((0, LABELS))

    def edge_array(self) -> np.ndarray:
        return np.array(self.edges, np.int64).reshape(-1, 3)


def _covering(spans: list[tuple[int, int, int]], first: int, start: int, end: int) -> int:
    """The kind of the span, from the ``first`` that may reach so far, that covers at least half of a token; OTHER without one."""
    best = (0, 0)
    for s, kind, e in spans[first:]:
        if s >= end:
            break
        if s < end and start < e:
            best = max(best, (min(e, end) - max(s, start), -kind))
    return -best[1] if best[0] * 2 >= end - start else OTHER


class Weights:
    """Log-linear weights: features by label, and a table of label pairs for each kind of edge."""

    def __init__(self, unary: np.ndarray, pairs: np.ndarray):
        self.unary, self.pairs = unary, pairs


def fit(texts: list[str], rounds: int = 300, rate: float = 1.0, decay: float = 1e-3) -> Weights:
    """Piecewise training: a multinomial logistic regression for the nodes, agreement log-odds for the edges."""
    field = Field(texts)
    x, y = np.zeros((field.n, N_FEATURES)), np.array(field.label, np.int64)
    for i, row in enumerate(field.rows):
        x[i, row] = 1
    w = np.zeros((N_FEATURES, LABELS))
    if field.n:
        goal = np.eye(LABELS)[y]
        for _ in range(rounds):
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            w -= rate * (x.T @ (p - goal) / field.n + decay * w)
    pairs = np.zeros((2, LABELS, LABELS))
    edges = field.edge_array()
    for kind in (0, 1):
        e = edges[edges[:, 2] == kind]
        seen = np.full((LABELS, LABELS), 0.5)
        if kind:
            seen += 50 * np.eye(LABELS)  # repeats agree, until the sample says otherwise
        np.add.at(seen, (y[e[:, 0]], y[e[:, 1]]), 1)
        joint = seen / seen.sum()
        table = np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0)))
        pairs[kind] = np.clip((table + table.T) / 2 if kind else table, -4, 4)
    return Weights(w, pairs)


def marginals(field: Field, weights: Weights, rounds: int = 100, damping: float = 0.3, settled: float = 1e-4) -> np.ndarray:
    """Loopy belief propagation, damped, over all fields at once, until no message changes by more than ``settled``.

    Loops of disagreeing potentials may swing for ever; ``rounds`` ends those, and the damped messages are taken as they stand.
    """
    unary, e = field.unary(weights.unary) + field.observed(), field.edge_array()
    n = len(e)
    src, dst = np.concatenate([e[:, 0], e[:, 1]]), np.concatenate([e[:, 1], e[:, 0]])
    # A clear mention is certain, so its potential weighs twice that between mentions that are not.
    tables = weights.pairs[np.minimum(e[:, 2], 1)] * np.maximum(e[:, 2], 1)[:, None, None]
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    messages = np.zeros((2 * n, LABELS))
    for _ in range(rounds if n else 0):
        belief = unary.copy()
        np.add.at(belief, dst, messages)
        z = (belief[src] - messages[back])[:, :, None] + tables
        top = z.max(axis=1, keepdims=True)
        new = np.log(np.exp(z - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        step = (1 - damping) * (new - messages)
        messages += step
        if np.abs(step).max(initial=0.0) <= settled:
            break
    np.add.at(unary, dst, messages)
    p = np.exp(unary - unary.max(axis=1, keepdims=True)) if field.n else unary
    return p / p.sum(axis=1, keepdims=True) if field.n else p


def all_spans(texts: list[str], weights: Weights, least: float = 0.9) -> list[list[tuple[int, int, int]]]:
    """Per text the fixed forms and, where they leave room, runs of neighbouring tokens with a likely kind."""
    base = [base_spans(t) for t in texts]
    field, added = Field(texts, base), [[] for _ in texts]
    p = marginals(field, weights)
    i, k = 0, -1
    while i < field.n:
        kind = int(p[i].argmax())
        j = i + 1
        if kind == OTHER or p[i, kind] < least:
            i = j
            continue
        if field.owner[i] != k:
            k = field.owner[i]
            begins, furthest = [s for s, _, _ in base[k]], list(itertools.accumulate((e for _, _, e in base[k]), max))
        while j < field.n and field.owner[j] == k and field.starts[j] - field.ends[j - 1] <= 2 and p[j].argmax() == kind and p[j, kind] >= least:
            j += 1
        text, start, end = texts[k], field.starts[i], field.ends[j - 1]
        i = j
        while end > start and text[end - 1] in ".,;:!?\"'":
            end -= 1
        while start < end and text[start] in ".,;:!?\"'":
            start += 1
        size = len(digits_of(text[start:end]))
        # Half an entity is none: the run has to hold what its kind needs. It is left out where a fixed form touches it.
        whole = {0: "@" in text[start:end], 1: size >= 4, 2: 14 <= size <= 19, 3: 7 <= size <= 15}[kind]
        before = bisect.bisect_left(begins, end)
        if whole and not (before and furthest[before - 1] > start):
            added[k].append((start, kind, end))
    return [sorted(x + y) for x, y in zip(base, added)]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def train(df: DataFrame, text_col: str = "text", rows: int = 2000, chars: int = 20_000) -> Weights:
    """Fits on about ``rows`` different texts that hold a digit or ``@`` and are no longer than ``chars``, chosen by a hash.

    The share to take follows from a count first, so each task sends its part of the sample only.
    """
    texts = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= chars))
    share = min(1.0, rows / max(1, texts.count()))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct().orderBy("text").collect()
    return fit([r.text for r in sample])


def _parts(batch: pa.RecordBatch, rows: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows, and of about so many characters: fields of long texts do not pile up."""
    first, n = 0, 0
    for k, m in enumerate(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()):
        if k - first == rows or (k > first and n + m > size):
            yield batch.slice(first, k - first)
            first, n = k, 0
        n += m
    if first < batch.num_rows:
        yield batch.slice(first)


def find_personal_data(df: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)`` for every row: counts and list of the fixed forms, and all spans.

    Spans are ``kind:start:end`` in code points. A null or empty text has none; repeated rows are judged alike; extra columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                texts = [t or "" for t in part.column("text").to_pylist()]
                spans = all_spans(texts, shared.value, least)
                base = [base_spans(t) for t in texts]
                counts = [pa.array([sum(s[1] == kind for s in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array([listed(b) for b in base]), pa.array([listed(s) for s in spans])], ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base string, spans string")
