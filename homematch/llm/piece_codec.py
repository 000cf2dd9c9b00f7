"""Exact SentencePiece BPE ids by a prefix table, and their decoding.

A text becomes pieces of a merge vocabulary. Every prefix of a text has one
last token: the token that ends there and is compatible with the last token of
what stands before it, where two tokens are compatible if merging their joined
text by the model's order gives just these two. An automaton over the
vocabulary finds the tokens that end at each place; the table keeps the one that
fits, and the ids are read from its end backwards. No merge queue is run over
the text.

The escaped space only ever starts a piece, so no merge crosses from a
character into a following space: the text is split there, and each different
unit is worked out once per worker.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Entries in each of the two generations of units that a worker keeps, and the longest unit it keeps.
CACHE_UNITS, CACHE_CHARS = 300_000, 64


def load_pieces(path: str) -> dict:
    """Pieces, scores and byte ids, read from a model file.

    A model that this codec would not encode exactly raises an error: one that
    is no merge model, changes texts before it splits them, drops blanks, adds
    no leading one, has pieces of its user, or no bytes to fall back on.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as layout

    with open(path, "rb") as file:
        spec = layout.ModelProto.FromString(file.read())
    trainer, rules = spec.trainer_spec, spec.normalizer_spec
    wrong = {
        "no merge model": trainer.model_type != trainer.BPE,
        "texts are normalised": bool(rules.precompiled_charsmap) or rules.name != "identity" or bool(rules.normalization_rule_tsv),
        "blanks are dropped": rules.remove_extra_whitespaces,
        "no leading blank": not rules.add_dummy_prefix or trainer.treat_whitespace_as_suffix,
        "blanks stay as they are": not rules.escape_whitespaces,
        "no byte fallback": not trainer.byte_fallback,
        "pieces of the user": any(p.type == p.USER_DEFINED for p in spec.pieces),
    }
    if any(wrong.values()):
        raise ValueError(f"{path}: {', '.join(k for k, v in wrong.items() if v)}")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return {
        "pieces": [(i, model.id_to_piece(i), model.get_score(i)) for i in plain],
        "bytes": [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        "size": size,
    }


class PieceCodec:
    """Encoder and decoder for one vocabulary whose text normalisation is the identity with a leading space."""

    def __init__(self, model: dict):
        self.ids = {piece: i for i, piece, _ in model["pieces"]}
        self.scores = {piece: score for _, piece, score in model["pieces"]}
        self.text = {i: piece for i, piece, _ in model["pieces"]}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece holds a space after a character; units would not be independent")
        self.bytes = model["bytes"]
        self.raw = [b""] * model["size"]
        for i, piece in self.text.items():
            self.raw[i] = piece.encode()
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if piece.strip(SPACE) or piece == SPACE:
                self.automaton.add_word(piece, (len(piece), piece))
        self.automaton.make_automaton()
        self.fits: dict[tuple[str, str], bool] = {}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Merges by definition: best score first, leftmost among equals. For short texts and for runs of spaces."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens stand side by side in an encoding; an empty left asks whether the right one can exist."""
        if len(self.fits) > 2 * CACHE_UNITS:
            self.fits.clear()
        known = self.fits[left, right] = self.merged(list(left + right)) == ([left, right] if left else [right])
        return known

    def tokens(self, unit: str) -> list[str]:
        """Tokens of a unit, that is at most one space and then characters; characters without a piece stand alone."""
        fits, compatible = self.fits, self.compatible
        last = [""] * (len(unit) + 1)
        done = 0
        for end, (length, piece) in self.automaton.iter(unit):
            end += 1
            if done == end:
                continue
            if done < end - 1:
                last[done + 1 : end] = unit[done : end - 1]
            before = end - length
            known = fits.get((last[before], piece))
            if known or (known is None and compatible(last[before], piece)):
                last[end] = piece
                done = end
            else:
                last[end] = unit[end - 1]
                done = end - 1
        last[done + 1 :] = unit[done:]
        out, at = [], len(unit)
        while at:
            token = last[at]
            out.append(token)
            at -= len(token)
        out.reverse()
        return out

    def spaces(self, count: int) -> list[str]:
        """Tokens of a run of spaces. Its merges all have one score and go leftmost first, so the head is final whatever follows."""
        out: list[str] = []
        head = len(self.merged([SPACE] * 64)[0])
        while count > 64:
            out.append(SPACE * head)
            count -= head
        return out + self.merged([SPACE] * count)

    def unit_ids(self, run: int, rest: str) -> list[int]:
        """Ids of ``run`` spaces followed by characters without spaces."""
        tokens = self.tokens(SPACE + rest) if rest else []
        if not rest:
            tokens = self.spaces(run)
        elif run > 1:
            loose = tokens[0] == SPACE
            head = run if loose else run - 1
            tokens = self.spaces(head) + (tokens[1:] if loose else tokens)
        out = []
        for token in tokens:
            i = self.ids.get(token)
            if i is not None:
                out.append(i)
            else:
                out += [self.bytes[b] for b in token.encode()]
        return out

    def packed(self, run: int, rest: str) -> bytes:
        return array("i", self.unit_ids(run, rest)).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, "<i4")
        units, out, run = self.units, [], 0
        for part in text.replace(SPACE, " ").split(" "):
            run += 1
            if not part:
                continue
            if run == 1:
                ids = units.get(part)
                if ids is None:
                    ids = self.older.get(part) or self.packed(1, part)
                    if len(part) <= CACHE_CHARS:
                        if len(units) >= CACHE_UNITS:
                            self.older, self.units = units, {}
                            units = self.units
                        units[part] = ids
            else:
                ids = self.packed(run, part)
            out.append(ids)
            run = 0
        if run:
            out.append(self.packed(run, ""))
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces and bytes joined, the leading space dropped, escapes undone."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text.removeprefix(SPACE).replace(SPACE, " ")


_codecs: dict[str, PieceCodec] = {}


def codec(name: str, model: dict) -> PieceCodec:
    """The codec of a worker, made once."""
    if name not in _codecs:
        _codecs[name] = PieceCodec(model)
    return _codecs[name]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of every whole text.

    The vocabulary (fixed size) is read once on the driver and broadcast. Null
    and empty texts have no ids and decode to an empty text. Texts of any length
    are worked in linear time. Repeated rows give repeated results, an empty
    table none; other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(path, model.value)
        for batch in batches:
            texts = batch.column(1)
            for start in range(0, max(batch.num_rows, 1), 1000):
                part = [t or "" for t in texts.slice(start, 1000).to_pylist()]
                ids = [use.encode(t) for t in part]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, 1000), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([use.decode(i) for i in ids], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
