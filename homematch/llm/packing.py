"""Token packing with bounded space: best fit into a fixed number of open windows.

Each task reads its documents in order and keeps a fixed number of open windows.
A document is cut into full windows and a rest; the rest goes to the open window
that it fills best. If none has room, the fullest is emitted and a new one is
opened. What stays open at the end of a task is merged afterwards, again best
fit, in groups of a bounded size, so nothing grows with the table in any task.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from homematch.session import saved

OPEN_WINDOWS = 64
GROUP_WINDOWS = 8192
END_ID = 0
#: Texts encoded and handed on at a time.
ROWS = 200
#: How byte-level vocabularies of this kind split a text before merging. Fixed value.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FIELDS = "start bigint, length bigint, doc_tokens bigint, window bigint, offset bigint, used bigint, closed boolean, ids binary"


def special_tokens(path: str) -> list[str]:
    """Texts of the tokens that are taken as they stand."""
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def vocabulary_ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token and its id; ids follow the order of merges.

    The file writes bytes that are no visible Latin-1 characters as characters
    from 256 on, in order.
    """
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(seen)]
    byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"]}
    return {bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}


class UnitTokenizer:
    """Ids of whole texts as the tokenizers library gives them.

    The units into which the vocabulary's pattern splits a text are merged by
    rank over the same vocabulary, which gives the same ids in less than half of
    the time. Nothing of a text is kept for later ones, so a worker's memory does
    not grow with the texts it has seen. A text that holds a special token is
    given to the library, which is loaded for the first of them.
    """

    def __init__(self, path: str):
        self.path, self.special = path, special_tokens(path)
        self.merger = tiktoken.Encoding("units", pat_str=SPLIT_PATTERN, mergeable_ranks=vocabulary_ranks(path), special_tokens={})

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids_of(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.merger.encode_ordinary(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        return [array("I", self.ids_of(t)).tobytes() for t in texts]


_tokenizers: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    """The tokenizer of a worker, made once."""
    if path not in _tokenizers:
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]


class Windows:
    """A fixed number of open windows and what each holds."""

    def __init__(self, size: int, keep: int, first: int):
        self.size, self.keep, self.next = size, keep, first
        self.room: dict[int, int] = {}
        self.held: dict[int, list] = {}

    def put(self, length: int, items: list) -> tuple[int, int, list | None]:
        """Place ``items`` of a length. Returns the window, the offset, and the items of a window that had to go."""
        fits = [(room, w) for w, room in self.room.items() if room >= length]
        gone = None
        if fits:
            _, at = min(fits)
        else:
            if len(self.room) == self.keep:
                gone = self.held.pop(fullest := min(self.room, key=lambda w: (self.room[w], w)))
                del self.room[fullest]
            at, self.next = self.next, self.next + 1
            self.room[at], self.held[at] = self.size, []
        offset = self.size - self.room[at]
        self.room[at] -= length
        self.held[at] += items
        return at, offset, gone

    def full(self, window: int) -> list | None:
        """Items of a window that has no room left; it is open no longer."""
        if self.room[window]:
            return None
        del self.room[window]
        return self.held.pop(window)


def frame(pieces: list[tuple], used: dict[int, int], closed: bool, key: pa.DataType) -> pa.RecordBatch:
    """Rows of pieces (key, start, length, doc_tokens, window, offset, ids)."""
    columns = list(zip(*pieces, strict=True)) if pieces else [()] * 7
    whole = [pa.array(c, pa.int64()) for c in columns[1:6]]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], key), *whole, pa.array([used[w] for w in columns[4]], pa.int64()), pa.array([closed] * len(pieces), pa.bool_()), pa.array(columns[6], pa.binary())],
        ["doc_id", "start", "length", "doc_tokens", "window", "offset", "used", "closed", "ids"],
    )


def pack_tasks(docs: DataFrame, path: str, size: int, keep: int, key: str, text: str) -> DataFrame:
    """Pieces of all documents, packed task by task; the last open windows are not ``closed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = tokenizer(path)
        first = TaskContext.get().partitionId() << 32
        windows, kind, pieces, used = Windows(size, keep, first), None, [], {}

        def close(items: list | None) -> None:
            if items:
                pieces.extend(items)
                used[items[0][4]] = sum(i[2] for i in items)

        for batch in batches:
            kind = batch.schema.field(0).type
            for start in range(0, batch.num_rows, ROWS):
                keys = batch.column(0).slice(start, ROWS).to_pylist()
                texts = [t or "" for t in batch.column(1).slice(start, ROWS).to_pylist()]
                for name, ids in zip(keys, use.encode(texts), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    total = len(ids) // 4
                    for at in range(0, total, size):
                        length = min(size, total - at)
                        window, offset, gone = windows.put(length, [])
                        close(gone)
                        windows.held[window].append((name, at, length, total, window, offset, ids[4 * at : 4 * (at + length)]))
                        close(windows.full(window))
                yield frame(pieces, used, True, kind)
                pieces, used = [], {}
        if kind is not None:
            rest = [i for items in windows.held.values() for i in items]
            yield frame(rest, {w: size - room for w, room in windows.room.items()}, False, kind)

    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FIELDS}")


def merge_group(size: int):
    """Best fit of one group's half-filled windows, fullest first."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["window"].to_pylist(), table["used"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
        by_room: list[set[int]] = [set() for _ in range(size + 1)]
        out = []
        for window, used in rows:
            best = next((r for r in range(used, size + 1) if by_room[r]), None)
            target = window if best is None else min(by_room[best])
            shift = 0 if best is None else size - best
            if best is not None:
                by_room[best].remove(target)
            by_room[(size if best is None else best) - used].add(target)
            out.append((window, target, shift))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("window", "target", "shift"), zip(*out, strict=True), strict=True)})

    return run


def pack_documents(
    docs: DataFrame, path: str, size: int = 1024, keep: int = OPEN_WINDOWS, group: int = GROUP_WINDOWS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` tokens, with their ids.

    A document is its text's ids and then id 0; a null or empty text is the
    single id 0. Long documents are cut into full sequences and a rest. Repeated
    rows are packed each; an empty table gives no rows; other columns, whatever
    their names, are ignored. The pieces are written once below the shared
    folder, as the merge of leftovers needs them again.
    """
    pieces = saved(pack_tasks(docs, path, size, keep, key, text), "pieces")
    left = pieces.where("NOT closed").groupBy("window").agg(F.max("used").alias("used"))
    spread = left.withColumn("_group", F.pmod(F.xxhash64("window"), F.lit(max(1, -(-left.count() // group)))))
    moves = saved(spread.groupBy("_group").applyInArrow(merge_group(size), "window bigint, target bigint, shift bigint"), "moves")
    open_pieces = pieces.where("NOT closed").join(moves, "window")
    names = ["doc_id", "start", "length", "doc_tokens"]
    done = pieces.where("closed").select(*names, F.col("window").alias("sequence_id"), "offset", "ids")
    moved = open_pieces.select(*names, F.col("target").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"), "ids")
    return done.unionByName(moved)
