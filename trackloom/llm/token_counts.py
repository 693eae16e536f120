"""Token counts of byte-level byte-pair vocabularies.

A text is split as the vocabulary's library splits it. The bytes of a piece are a linked list of symbols, and a heap holds its adjacent pairs by
rank and place: the lowest is popped and merged, and the pairs that its neighbours form with the new symbol are pushed, until no pair has a
rank. A piece has as many tokens as it had bytes, less the merges; no identifiers leave the operator.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Long texts are split in slices of about so many characters, cut where a piece ends anyway.
SLICE = 1 << 20
#: Counts of so many pieces, of at most so many characters each, are remembered by a worker.
REMEMBERED, SHORT = 1 << 19, 32
#: Longer pieces keep their symbols in packed arrays.
PACKED = 1 << 12
_LOW = (1 << 32) - 1
#: Between a printable ASCII character and a space or line break a piece always ends.
_CUT = regex.compile(r"(?<=[!-~])[ \n]")
#: How byte-level vocabularies of this family split texts, with their classes of letters, numbers and white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{s}{L}{N}]+|{s}+(?![^{s}])|{s}+"
_CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "s": r"\s"}


def byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in such files: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranges(points: list[int]) -> str:
    """A class of code points."""
    out, k = [], 0
    while k < len(points):
        first = k
        while k + 1 < len(points) and points[k + 1] == points[k] + 1:
            k += 1
        out.append(f"\\U{points[first]:08x}-\\U{points[k]:08x}")
        k += 1
    return "".join(out)


def _classes_of(points: list[int]) -> dict[str, set[int]]:
    text = "".join(map(chr, points))
    return {k: set(map(ord, regex.findall(p, text))) for k, p in _CLASSES.items()}


def _class_probe(tokenizer, points: list[int]) -> dict[str, set[int]]:
    """The library's classes of code points, found by letting it split a text of them: with a fellow of its class a code point is one piece."""
    found = {}
    for kind, text in (("L", "!a{}"), ("N", "!1{}"), ("s", "a{}!")):
        whole = "".join(text.format(chr(c)) for c in points)
        starts = {span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(whole)}
        # A piece begins at the third character if the second is no fellow of it; so it does after white space.
        found[kind] = {c for k, c in enumerate(points) if (3 * k + 2 in starts) == (kind == "s")}
    found["s"] -= found["L"] | found["N"]
    return found


def _doubtful(tokenizer, classes: dict[str, set[int]]) -> list[int]:
    """Code points in runs of one class that the library does not split as such a run."""
    kind_of = {c: k for k, points in classes.items() for c in points}
    runs: list[tuple[str, list[int]]] = []
    for c in range(0x80, 0x110000):
        if not 0xD800 <= c < 0xE000:
            kind = kind_of.get(c, "o")
            if kind == "s":
                runs.append((kind, [c]))
            elif runs and runs[-1][0] == kind and runs[-1][1][-1] == c - 1:
                runs[-1][1].append(c)
            else:
                runs.append((kind, [c]))
    before = {"L": "!a", "N": "!1", "o": "1!", "s": "1!"}
    text, spans, at = [], [], 0
    for kind, run in runs:
        text.append(before[kind] + "".join(map(chr, run)) + ("!" if kind == "s" else ""))
        spans.append((at + 1, at + 2 + len(run)) if kind != "s" else (at + 1, at + 2))
        at += len(text[-1])
    pieces = {span for _, span in tokenizer.pre_tokenizer.pre_tokenize_str("".join(text) + "1")}
    return [c for (_, run), span in zip(runs, spans) if span not in pieces for c in run]


class Splitter:
    """Splits texts as the library does. Its Unicode version and that of ``regex`` may differ: texts with code points that they class
    differently are split by a (slower) pattern with the library's classes."""

    def __init__(self, tokenizer):
        mine = _classes_of([c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000])
        points = _doubtful(tokenizer, mine)
        theirs, mine = _class_probe(tokenizer, points), _classes_of(points)
        self.odd = frozenset(map(chr, set().union(*(theirs[k] ^ mine[k] for k in mine))))
        #: No text whose bytes are all below this one has an odd code point.
        self.lead = min((c.encode()[0] for c in self.odd), default=0x100)
        odd = _ranges(sorted(map(ord, self.odd)))
        own = {k: f"[{p}--[{odd}]]" if odd else p for k, p in _CLASSES.items()}
        for k in own:
            extra = _ranges(sorted(theirs[k] - mine[k]))
            if extra:
                own[k] = f"[{own[k]}||[{extra}]]"
        self.usual, self.exact = _SPLIT.format(**_CLASSES), "(?V1)" + _SPLIT.format(**own)

    def __call__(self, text: str) -> list[str]:
        odd = not text.isascii() and max(text.encode()) >= self.lead and not self.odd.isdisjoint(text)
        return regex.findall(self.exact if odd else self.usual, text)


class Vocabulary:
    """Ranks of pairs of a ``tokenizers`` file of byte-level BPE, its special strings and how it splits texts. Its size is that of the file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer  # the driver's; tasks get what is found here

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec["normalizer"]
        if not plain or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        added = spec["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has special strings with conditions")
        self.specials = sorted((t["content"] for t in added), key=len, reverse=True)
        vocab = model["vocab"]
        letters = byte_letters()
        self.start = [0] * 256
        for letter, byte in letters.items():
            self.start[byte] = vocab[letter]
        #: (left symbol, right symbol) to (rank, merged symbol), both packed.
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        #: The same of the pairs of bytes, without the merged symbol.
        byte_of = {symbol: b for b, symbol in enumerate(self.start)}
        self.first = {}
        for pair, found in self.pairs.items():
            a, b = byte_of.get(pair >> 32), byte_of.get(pair & _LOW)
            if a is not None and b is not None:
                self.first[a << 8 | b] = found & ~_LOW
        self.split = Splitter(Tokenizer.from_file(path))

    def piece_tokens(self, piece: bytes) -> int:
        """Symbols less merges. The lists and the heap of a long piece take about 60 bytes for each of its bytes."""
        n, start, pair_of = len(piece), self.start, self.pairs.get
        ids, left, right = [start[b] for b in piece], range(-1, n - 1), range(1, n + 1)
        if n < PACKED:
            left, right = list(left), list(right)
        else:
            ids, left, right = array("q", ids), array("q", left), array("q", right)
        heap, first = [], self.first.get
        for i in range(n - 1):
            found = first(piece[i] << 8 | piece[i + 1])
            if found is not None:
                heap.append(found | i)
        heapify(heap)
        merges = 0
        while heap:
            top = heappop(heap)
            i = top & _LOW
            j, symbol = right[i], ids[i]
            if symbol < 0 or j == n:
                continue
            found = pair_of(symbol << 32 | ids[j])
            if found is None or found >> 32 != top >> 32:
                continue  # the pair of this place is another by now
            merges += 1
            symbol = ids[i] = found & _LOW
            ids[j] = -1
            after, before = right[j], left[i]
            right[i] = after
            if after < n:
                left[after] = i
                found = pair_of(symbol << 32 | ids[after])
                if found is not None:
                    heappush(heap, found & ~_LOW | i)
            if before >= 0:
                found = pair_of(ids[before] << 32 | symbol)
                if found is not None:
                    heappush(heap, found & ~_LOW | before)
        return n - merges


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


class _Counts(dict):
    """Tokens of pieces, as they are asked for, in two generations: a full one becomes the old one, and what is asked for again comes back."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.old = vocabulary, {}

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece) or self.vocabulary.piece_tokens(piece.encode())
        if len(piece) <= SHORT:
            if 2 * len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = n
        return n

    def of(self, text: str) -> int:
        total, parts = 0, [text]
        if self.vocabulary.specials:
            special = regex.compile("|".join(map(regex.escape, self.vocabulary.specials)))
            parts = special.split(text)
            total = len(parts) - 1
        for part in parts:
            for piece in slices(part):
                total += sum(map(self.__getitem__, self.vocabulary.split(piece)))
        return total


#: What a worker's last task remembered; the vocabulary of a broadcast is one object for all tasks of a worker.
_last: list[_Counts] = []


def _counts_of(words: Vocabulary) -> _Counts:
    if not _last or _last[0].vocabulary is not words:
        _last[:] = [_Counts(words)]
    return _last[0]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once by a driver."""
    return Vocabulary(path)


def count_tokens(df: DataFrame, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row, from whole texts.

    A null or empty text has no bytes and no tokens. Special strings inside a text are one token each. Repeated rows give equal
    results, ids may be null, an empty table gives an empty one; extra columns, whatever their names, are left out. No row leaves its task, so
    neither copies nor sources can gather; a text's memory is its own size, and about 60 bytes for each byte of its longest run without a break.
    """
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    shared = df.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts_of(shared.value)
        for batch in batches:
            n = pa.array([counts.of(t.as_py()) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
