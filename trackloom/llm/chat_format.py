"""Chat formatting: records of any known layout become canonical turns, and turns become marked text with a loss mask.

The layout of a JSON record is recognised by a fingerprint: the hash of its sorted nested field paths. A declarative mapping
says for each fingerprint where roles and texts are. Control strings inside texts are escaped, so that the marked text can be read back
exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*+)\|"), re.compile(r"<(\\*)\\\|")
_PIECE = re.compile(r"<\|im_start\|>([^\n]*+)\n(.*)<\|im_end\|>\n", re.S)
#: Names of speakers in other layouts (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def escape(text: str) -> str:
    """No control string survives: in ``<|``, with any backslashes between, one more backslash is put before the bar."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a JSON value: names joined by dots, ``[]`` for the elements of a list."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at + "{}"}
    if isinstance(value, list):
        return set().union(*(paths(v, at + "[]") for v in value)) if value else {at + "[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are: in a list of ``(role, text)`` fields, or in single fields with given roles, in order."""

    name: str
    turns: tuple[tuple[str, str], ...]
    each: str | None = None
    #: Fields that may be missing, and such as are ignored where they occur.
    optional: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    #: Whether names of speakers are translated; rows that hold canonical turns already keep theirs.
    renamed: bool = True

    def layouts(self) -> Iterator[set[str]]:
        if self.each is not None:
            role, text = self.turns[0]
            needed = [{f"{self.each}[].{role}", f"{self.each}[].{text}"}, {f"{self.each}[]"}]
        elif self.turns[0][0].startswith("$"):
            needed = [{self.turns[0][0][1:], self.turns[0][1]}]
        else:
            needed = [{t for _, t in self.turns} - set(self.optional)]
        extra = [*self.optional, *self.ignored]
        for base in needed:
            for k in range(len(extra) + 1):
                for more in combinations(extra, k):
                    yield base | set(more)

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.each is not None:
            role, text = self.turns[0]
            found = [(x[role], x[text]) for x in record[self.each]]
        else:
            found = [(record[r[1:]] if r.startswith("$") else r, record[t]) for r, t in self.turns if t in record and not (t in self.optional and not record[t])]
        return [(ROLES.get(r or "", r or "") if self.renamed else r or "", t if isinstance(t, str) else "" if t is None else json.dumps(t)) for r, t in found]


MAPPINGS = (
    Mapping("turn", (("$role", "text"),), ignored=("conv_id", "turn"), renamed=False),
    Mapping("messages", (("role", "content"),), each="messages", ignored=("id", "source")),
    Mapping("conversations", (("from", "value"),), each="conversations", ignored=("id", "source")),
    Mapping("instruction", (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input"), ignored=("id",)),
    Mapping("prompt", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",), ignored=("id",)),
    Mapping("response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",), ignored=("id",)),
    Mapping("question", (("user", "question"), ("assistant", "answer")), ignored=("id",)),
)


def registry(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(layout): m for m in reversed(mappings) for layout in m.layouts()}


def canonical_turns(df: DataFrame, conv_col: str, order_col: str, record_col: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``(conv_id, place, turn, role, text, layout)``: the turns of each JSON record.

    A record whose layout is not known, or that is no JSON object, gives one row with a null role and layout ``unknown`` (its text is the
    record), so nothing is lost silently. A null record counts as unknown, with an empty text.
    """
    known = registry(mappings)

    def rows(record: str | None) -> Iterator[tuple[int, str | None, str, str]]:
        try:
            value = json.loads(record or "")
            mapping = known.get(fingerprint(paths(value))) if isinstance(value, dict) else None
            found = mapping.read(value) if mapping else None
        except (ValueError, RecursionError):
            found = None
        if found is None:
            yield 0, None, record or "", "unknown"
        else:
            for k, (role, text) in enumerate(found):
                yield k, role, text, mapping.name

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(c, p, *row) for c, p, r in zip(frame["conv_id"], frame["place"], frame["record"]) for row in rows(r)]
            yield pd.DataFrame(out, columns=["conv_id", "place", "turn", "role", "text", "layout"]).astype({"conv_id": "Int64", "place": "Int64"})

    source = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(order_col).cast("long").alias("place"), F.col(record_col).alias("record"))
    return source.mapInPandas(work, "conv_id long, place long, turn int, role string, text string, layout string")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and the range of it that the loss covers: all of an assistant's text, else nothing."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    covered = (len(head), len(head) + len(body)) if role == "assistant" else (0, 0)
    return f"{head}{body}{END}\n", *covered


def format_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_start, loss_end)``: one row a turn, in the order of each conversation inside its partition.

    Conversations are dealt by id and sorted by place, turn, role and text; a conversation's formatted text is its rows laid end to end, and
    a mask counts code points from the start of its row. Rows rather than whole conversations keep memory bounded for any length.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [format_turn(r or "", t or "") for r, t in zip(frame["role"], frame["text"])]
            yield pd.DataFrame({"conv_id": frame["conv_id"], "formatted": [x[0] for x in out], "loss_start": [x[1] for x in out], "loss_end": [x[2] for x in out]}).astype({"conv_id": "Int64"})

    dealt = turns.select("conv_id", "place", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "role", "text")
    return dealt.mapInPandas(work, "conv_id long, formatted string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` from the rows of ``format_turns``.

    Runs in the same stage on the same order; of a conversation only two running digests and three counts are held.
    """
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_, done = None, []

        def close() -> None:
            if open_:
                conv, n, turns, loss_chars, loss, chars = open_
                done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for frame in frames:
            for conv, piece, start, end in zip(frame["conv_id"].astype("Int64"), frame["formatted"], frame["loss_start"], frame["loss_end"]):
                conv = None if pd.isna(conv) else int(conv)
                if open_ is None or open_[0] != conv:
                    close()
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = _PIECE.fullmatch(piece).groups()
                open_[1] += 1
                open_[2].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                covered = unescape(piece[start:end])
                open_[3] += len(covered)
                open_[4].update(covered.encode("utf-8", "surrogatepass"))
                open_[5] += len(piece)
            if done:
                yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
                done.clear()
        close()
        if done:
            yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})

    return formatted.mapInPandas(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
