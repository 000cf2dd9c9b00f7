"""Alignment of the tokens that two tokenizers give for the same bytes.

Both token rows of a text cover the same bytes, so their ends are two rising
sequences. A byte place where tokens of both end is a shared cut. Cuts are found
by divide and conquer: in an interval the end near its middle that both have is
located by bisection, both halves are worked on in the same way, and an interval
without a shared end inside is a leaf group. The intervals of one level, of all
documents of a batch, are worked on together in numpy.

Tokens linked at a cut end at the same byte, so one's bytes end the other's.
The pairs that can ever be linked therefore follow from the two vocabularies
alone; each has a number, and corpus-wide counts are one array of that fixed
size, however large the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from homematch.llm.packing import SPLIT_PATTERN, vocabulary_ranks
from homematch.session import scratch_path

SPACE = "▁"
#: Characters of text worked on at a time; a longer text is worked on alone and whole.
SLICE_CHARS = 2_000_000
FIELDS = "n_a bigint, n_b bigint, n_groups bigint, groups string, links binary"


def load_vocabularies(path_a: str, path_b: str) -> dict:
    """Bytes of every id of a byte-level vocabulary and of a piece vocabulary, and the numbered pairs."""
    import sentencepiece

    ranks = vocabulary_ranks(path_a)
    a = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        a[i] = token
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    b = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        b.append(b"" if special else bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
    with open(path_b, "rb") as file:
        return {"name": f"{path_a} {path_b}", "a": a, "b": b, "ranks": ranks, "model": file.read(), "pairs": possible_pairs(a, b)}


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted numbers ``id_a * len(b) + id_b`` of all pairs of which one token's bytes end the other's.

    There are fewer than bytes in both vocabularies together, times the ids that
    share their bytes.
    """

    def places(tokens: list[bytes]) -> dict[bytes, list[int]]:
        out: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            if token:
                out.setdefault(token, []).append(i)
        return out

    found = set()
    for tokens, others, from_a in ((a, places(b), True), (b, places(a), False)):
        for i, token in enumerate(tokens):
            for start in range(len(token)):
                for j in others.get(token[start:], ()):
                    found.add(i * len(b) + j if from_a else j * len(b) + i)
    return np.array(sorted(found), np.int64)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both rising sequences of all ends that both have.

    ``last_a`` and ``last_b`` are the places of the documents' last tokens,
    which end together.
    """
    cuts = [(last_a, last_b)]
    low_a, high_a = np.r_[0, last_a[:-1] + 1].astype(np.int64), last_a.astype(np.int64)
    low_b, high_b = np.r_[0, last_b[:-1] + 1].astype(np.int64), last_b.astype(np.int64)
    while len(low_a):
        open_ = (high_a > low_a) & (high_b > low_b)  # ends inside an interval stand before its last token
        low_a, high_a, low_b, high_b = low_a[open_], high_a[open_], low_b[open_], high_b[open_]
        middle = (low_a + high_a) >> 1
        at_a, at_b = np.full(len(low_a), -1), np.full(len(low_a), -1)
        left, distance = np.arange(len(low_a)), 0
        while len(left):
            for side in (1, -1) if distance else (1,):
                probe = middle[left] + side * distance
                inside = np.flatnonzero((probe >= low_a[left]) & (probe < high_a[left]))
                ends = ends_a[probe[inside]]
                place = np.searchsorted(ends_b, ends)
                hit = (ends_b[np.minimum(place, len(ends_b) - 1)] == ends) & (at_a[left[inside]] < 0)
                at_a[left[inside[hit]]], at_b[left[inside[hit]]] = probe[inside[hit]], place[hit]
            distance += 1
            goes_on = (at_a[left] < 0) & ((middle[left] - distance >= low_a[left]) | (middle[left] + distance < high_a[left]))
            left = left[goes_on]
        found = at_a >= 0
        at_a, at_b = at_a[found], at_b[found]
        cuts.append((at_a, at_b))
        low_a, high_a = np.r_[low_a[found], at_a + 1], np.r_[at_a, high_a[found]]
        low_b, high_b = np.r_[low_b[found], at_b + 1], np.r_[at_b, high_b[found]]
    a, b = (np.concatenate(c) for c in zip(*cuts, strict=True))
    order = np.argsort(a)
    return a[order].astype(np.int64), b[order].astype(np.int64)


class Aligner:
    """Both tokenizers and their tables, made once per worker."""

    def __init__(self, known: dict):
        import sentencepiece

        self.a = tiktoken.Encoding("a", pat_str=SPLIT_PATTERN, mergeable_ranks=known["ranks"], special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=known["model"])
        self.raw_b, self.pairs = known["b"], known["pairs"]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in known[k]], np.int64) for k in "ab")
        #: Texts of the ids of a and b as they stand inside a group and as its last of their kind.
        self.shown = [f"{i}{end}" for size, ends in ((len(self.sizes_a), ",|"), (len(self.sizes_b), ",;")) for end in ends for i in range(size)]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none where a text is empty or its bytes do not come back."""
        none = np.empty(0, np.int64)
        out: tuple[list, list] = ([], [])
        for text, ids_b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1), strict=True):
            a = b = none
            if text:
                whole = f" {text}"
                ids_a = self.a.encode_ordinary(whole)
                content = whole.encode()
                if b"".join(map(self.raw_b.__getitem__, ids_b)) == content and self.a.decode_bytes(ids_a) == content:
                    a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
            out[0].append(a)
            out[1].append(b)
        return out

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, groups, links) of each text."""
        per_a, per_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in per], np.int64) for per in (per_a, per_b))
        a, b = np.concatenate(per_a), np.concatenate(per_b)
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        full = n_a > 0
        cut_a, cut_b = shared_cuts(np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b]), stop_a[full] - 1, stop_b[full] - 1)
        numbers = np.searchsorted(self.pairs, a[cut_a] * len(self.sizes_b) + b[cut_b]).astype("<i4")
        # a token of a stands behind all tokens of b of earlier groups, one of b behind those of a up to its own group
        behind_a = np.repeat(np.r_[0, cut_b[:-1] + 1], np.diff(cut_a, prepend=-1))
        behind_b = np.repeat(cut_a + 1, np.diff(cut_b, prepend=-1))
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a], last_b[cut_b] = 1, 1
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + behind_a] = a + last_a * len(self.sizes_a)
        codes[np.arange(len(b)) + behind_b] = 2 * len(self.sizes_a) + b + last_b * len(self.sizes_b)
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        cuts = np.searchsorted(cut_a, stop_a).tolist()
        out, first, cut = [], 0, 0
        for stop, next_cut, count_a, count_b in zip((stop_a + stop_b).tolist(), cuts, n_a.tolist(), n_b.tolist(), strict=True):
            out.append((count_a, count_b, next_cut - cut, "".join(shown[first:stop])[:-1], numbers[cut:next_cut].tobytes()))
            first, cut = stop, next_cut
        return out


_aligners: dict[str, Aligner] = {}


def aligner(known: dict) -> Aligner:
    """The aligner of a worker, made once."""
    name = known["name"]
    if name not in _aligners:
        _aligners[name] = Aligner(known)
    return _aligners[name]


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``SLICE_CHARS`` characters each."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= SLICE_CHARS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def align_documents(docs: DataFrame, known: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, links) of every document.

    ``groups`` shows the ids of each group, ``a1,a2|b1;a3|b2,b3``; ``links``
    holds the numbers (32 bits, little-endian) of the linked pairs in order.
    Null and empty texts, and texts of which a tokenizer does not give the bytes
    back, have no tokens and no groups. Strings of special tokens are plain
    text. Texts of any length are worked on whole. Repeated rows give repeated
    results, an empty table none; other columns, whatever their names, are
    ignored. The vocabularies (fixed size) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    names = ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")]]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = aligner(shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                texts = part.column(1).to_pylist()
                for start, stop in slices(texts):
                    columns = zip(*use.align(texts[start:stop]), strict=True)
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(start, stop - start), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FIELDS}")


def link_counts(aligned: DataFrame, pairs: int) -> np.ndarray:
    """How many links of all documents hold each numbered pair; an array of the vocabularies' size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(pairs, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                joined = b"".join(batch.column(0).slice(start, 500).to_pylist())
                counts += np.bincount(np.frombuffer(joined, "<i4"), minlength=pairs)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["pair", "n"])

    total = aligned.select("links").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(pairs, np.int64)
    counts[total["pair"].to_numpy()] = total["n"].to_numpy()
    return counts


def with_counts(aligned: DataFrame, known: dict) -> DataFrame:
    """Adds ``n_links``, ``n_best`` and ``count_sum`` to aligned documents.

    A link is best where no pair with its id of b is linked more often in the
    corpus; all that tie are.
    """
    pairs, ids_b = known["pairs"], len(known["b"])
    counts = link_counts(aligned, len(pairs))
    most = np.zeros(ids_b, np.int64)
    np.maximum.at(most, pairs % ids_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == most[pairs % ids_b]))
    rest = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            at = batch.schema.names.index("links")
            found = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column(at)]
            sums = [len(x) for x in found], [int(best[x].sum()) for x in found], [int(counts[x].sum()) for x in found]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns) if i != at], *[pa.array(s, pa.int64()) for s in sums]], [*rest, "n_links", "n_best", "count_sum"])

    fields = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in rest)
    return aligned.mapInArrow(run, f"{fields}, n_links bigint, n_best bigint, count_sum bigint")


def stored(aligned: DataFrame) -> DataFrame:
    """Aligned documents written below the shared folder, since their links are read twice."""
    path = scratch_path(aligned.sparkSession, "aligned")
    aligned.write.option("compression", "zstd").parquet(path)
    return aligned.sparkSession.read.schema(aligned.schema).parquet(path)
