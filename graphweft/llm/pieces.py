"""SentencePiece encoding and decoding: exact merge-type (BPE) encoding by backtracking.

Merging repeatedly joins the adjacent pair whose joined piece has the best score.
Its result is the only cutting into reachable pieces in which every two neighbours
are compatible, that is, merging their joined text gives the two back. So the encoder
walks from the left with the longest piece (Aho-Corasick), steps to the next shorter one
when a pair is not compatible or a position is known to lead nowhere (a bit per
position), and drops the last piece when nothing is left to try.

White space is written as U+2581, one is put in front, and no piece of a model holds
U+2581 behind another character, so a text is cut before each run of U+2581 and the
parts are encoded by themselves; models with other pieces are refused. Merging cannot cross a
border of two characters that no piece holds side by side, so parts are cut there too
before they are looked up. Characters that no piece covers become the pieces of their
UTF-8 bytes.

A null text counts as empty and has no ids. Texts are processed whole; a part without
white space may be as long as it likes. Short parts are remembered per task, twice
``REMEMBERED`` of them at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import parts_of

SPACE = "▁"
REMEMBERED = 150_000
PAIRS = 250_000  # compatibility checks remembered
_PART = 2 << 20  # bytes of texts taken up at once
LONGEST_REMEMBERED = 48
UNKNOWN = " ⁇ "  # fixed value: what the unknown id decodes to

Part = tuple[int, str, bytes]
_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_RUNS = re.compile(r"[^\W\d_]+|[\W\d_]+")


class Pieces:
    """The tables of one model file and its two directions."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.text = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.byte = {i: int(self.text[i][3:5], 16) for i in range(len(self.text)) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.unknown = model.unk_id()
        plain = [i for i in range(len(self.text)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(SPACE in self.text[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds white space behind another character")
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.silent = {i for i in range(len(self.text)) if model.is_control(i)}
        self.dummy = model.normalize("a") == SPACE + "a"
        if model.normalize("a  b ") != (SPACE if self.dummy else "") + f"a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models that keep white space as it is are supported")
        self.shorter: dict[str, str | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.inside = {a + b for piece in self.id for a, b in zip(piece, piece[1:])}
        self.known: dict[str, Part] = {}
        self.older: dict[str, Part] = {}
        self.bytes = [b"" if i in self.silent else bytes([self.byte[i]]) if i in self.byte else (UNKNOWN if i == self.unknown else t).encode() for i, t in enumerate(self.text)]
        self.longest = ahocorasick.Automaton()  # reads backwards, so that a match ends where its piece starts
        for piece in self.id:
            if self.reachable(piece):
                self.longest.add_word(piece[::-1], piece)
        self.longest.make_automaton()
        #: what merging leaves in one piece
        self.whole = {piece for piece in self.id if self.reachable(piece)}

    def merged(self, part: str) -> list[str]:
        """What merging makes of a short part; the definition that the compatibility checks rest on."""
        symbols = list(part)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def next_shorter(self, piece: str) -> str | None:
        """The longest proper prefix of ``piece`` that merging can reach; at last the single character."""
        if piece not in self.shorter:
            self.shorter[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if self.reachable(piece[:n])), None)
        return self.shorter[piece]

    def reachable(self, piece: str) -> bool:
        return len(piece) == 1 or piece in self.id and self.compatible(piece, "")

    def compatible(self, left: str, right: str) -> bool:
        """Does merging keep the border between two pieces?"""
        pair = (left, right)
        if pair not in self.fits:
            self.fits[pair] = self.merged(left + right) == ([left, right] if right else [left])
        return self.fits[pair]

    def longest_at(self, part: str) -> list[str]:
        """The longest piece that starts at each position, or else the character there."""
        out = list(part)
        last, seen = len(part) - 1, -1
        for end, piece in self.longest.iter(part[::-1]):  # of several, the longest comes first
            if end != seen:
                out[last - end] = piece
                seen = end
        return out

    def cut(self, part: str) -> list[str]:
        """The pieces of a part, by backtracking."""
        if part in self.whole:
            return [part]
        n = len(part)
        longest = self.longest_at(part)
        if len(self.fits) > PAIRS:
            self.fits.clear()
        failed = bytearray(n // 8 + 1)  # a bit per position that leads nowhere
        pieces: list[str] = []
        at = 0

        fits, shorter, last = self.fits, self.shorter, ""

        piece = longest[0] if n else None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    fit = fits.get((last, piece)) if last else True
                    if fit if fit is not None else self.compatible(last, piece):
                        break
                piece = shorter[piece] if piece in shorter else self.next_shorter(piece)
            if piece is not None:
                pieces.append(piece)
                last = piece
                at = end
                piece = longest[at] if at < n else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not pieces:
                    raise ValueError("no exact cutting: the model's merges are not consistent")
                dropped = pieces.pop()
                last = pieces[-1] if pieces else ""
                at -= len(dropped)
                piece = self.next_shorter(dropped)
        return pieces

    def ids_of(self, part: str) -> list[int]:
        pieces, known = self.cut(part), self.id
        try:
            return [known[p] for p in pieces]
        except KeyError:
            pass
        ids: list[int] = []
        for piece in pieces:
            if piece in known:
                ids.append(known[piece])
            elif self.byte_id:
                ids += [self.byte_id[b] for b in piece.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def parts(self, text: str) -> list[str]:
        """A normalised text, cut before each run of white space."""
        if not text:
            return []
        marked = (SPACE if self.dummy else "") + text.replace(" ", SPACE)
        if marked[0] == SPACE and marked[-1] != SPACE and SPACE + SPACE not in marked:  # one before each word: no need to search
            return [SPACE + word for word in marked[1:].split(SPACE)]
        return _PARTS.findall(marked)

    def runs(self, part: str) -> list[str]:
        """A part cut between letters and others wherever no piece holds the two characters at the border."""
        out: list[str] = []
        for run in _RUNS.findall(part):
            if out and out[-1][-1] + run[0] in self.inside:
                out[-1] += run
            else:
                out.append(run)
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for part in self.parts(text or "") for i in self.part(part)[1].split(",")]

    def raw(self, ids: list[int]) -> bytes:
        """The bytes that ids stand for, white space still as U+2581; bytes that are no UTF-8 become U+FFFD."""
        table = self.bytes
        joined = b"".join([table[i] for i in ids])
        try:
            joined.decode()
            return joined
        except UnicodeDecodeError:
            pass
        out, run = bytearray(), bytearray()
        for i in [*ids, None]:
            if i in self.byte:
                run.append(self.byte[i])
                continue
            out += _repaired(bytes(run))
            run.clear()
            out += table[i] if i is not None else b""
        return bytes(out)

    def decode(self, ids: list[int]) -> str:
        text = self.raw(ids).decode()
        if self.dummy and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def part(self, part: str) -> Part:
        """Number of ids, the ids joined by commas, and the bytes they decode to."""
        found = self.known.get(part)
        if found is None:
            found = self.older.get(part) or self._new(part)
            if len(part) <= LONGEST_REMEMBERED:
                if len(self.known) >= REMEMBERED:  # parts unused since the last time go
                    self.older, self.known = self.known, {}
                self.known[part] = found
        return found

    def _new(self, part: str) -> Part:
        runs = self.runs(part)
        if len(runs) == 1:
            ids = self.ids_of(part)
            return len(ids), ",".join(map(str, ids)), self.raw(ids).replace(SPACE.encode(), b" ")
        found = [self.part(r) for r in runs]
        return sum([f[0] for f in found]), ",".join([f[1] for f in found]), b"".join([f[2] for f in found])

    def forget(self) -> None:
        """Drop what was remembered of the texts seen so far; which pieces go together is a matter of the model and stays."""
        self.known, self.older = {}, {}

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
        known, part = self.known.get, self.part
        parts = [known(p) or part(p) for p in self.parts(text or "")]
        decoded = b"".join(map(itemgetter(2), parts))
        if self.dummy and decoded[:1] == b" ":
            decoded = decoded[1:]
        return sum(map(itemgetter(0), parts)), hashlib.sha256(",".join(map(itemgetter(1), parts)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _repaired(run: bytes) -> bytes:
    """A run of byte pieces, each byte that starts no whole character replaced by U+FFFD."""
    out, at = bytearray(), 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out += run[at : at + size].decode().encode()
                at += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out += "�".encode()
            at += 1
    return bytes(out)


def _then(batches: Iterator[pa.RecordBatch], last) -> Iterator[pa.RecordBatch]:
    yield from batches
    last()


_loaded: dict[str, Pieces] = {}


def _pieces(name: str) -> Pieces:
    if name not in _loaded:
        _loaded[name] = Pieces(SparkFiles.get(name))
    return _loaded[name]


def _shipped(spark: SparkSession, model_file: str) -> str:
    """The model goes to every executor with the job; its name there."""
    spark.sparkContext.addFile(model_file)
    return model_file.rsplit("/", 1)[-1]


def encode(docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with an array of ids per text (an existing column of that name is replaced)."""
    name = _shipped(docs.sparkSession, model_file)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _pieces(name)
        for texts in batches:
            yield pa.array((model.encode(t.as_py()) for t in texts), pa.list_(pa.int32()))

    return docs.withColumn(ids_col, ids(F.col(text_col)))


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text that the ids stand for; null ids give an empty text."""
    name = _shipped(rows.sparkSession, model_file)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _pieces(name)
        for ids in batches:
            yield pa.array((model.decode(x.as_py() or []) for x in ids), pa.string())

    return rows.withColumn(text_col, text(F.col(ids_col)))


def digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: both directions without moving the ids out of the task."""
    name = _shipped(docs.sparkSession, model_file)
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(name)
        for batch in parts_of(_then(batches, model.forget), _PART):
            found = [model.digest(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
