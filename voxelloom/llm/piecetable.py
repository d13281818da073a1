"""SentencePiece (merge type) encoding by a prefix table, and decoding.

Encoding does not replay merges over the text. For every prefix of a stretch of
text the encoding's last token is unique: it is the one piece that ends there
(found by an automaton over the vocabulary) and is compatible with the last token
of the prefix before it. Two tokens are compatible if no merge across their
border would run before the merges that build them. Ids follow backwards from the
last prefix.

No piece holds the space mark after another character, so a stretch ends before
each mark, and stretches recur; each worker keeps two bounded generations of the ones it
has seen, with their ids. Decoding starts from the ids of a whole text. Runs of the mark are pieces of equal, lowest score, for which prefixes
are not unique; they merge last, from the left, and are replayed on their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Stretches in each of a worker's two generations, and the longest that is kept: about 110 MB at most in all, until the task ends.
KEPT, KEPT_LENGTH = 225_000, 48


class PieceTable:
    """A merge-type model without text normalisation, with byte fallback; others raise ValueError."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = [p.type for p in proto.pieces]
        spec = proto.normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        if proto.trainer_spec.model_type != 2 or not plain or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("only merge-type models without normalisation, user-defined or unused pieces are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = kinds
        self.end_id = next(i for i, p in enumerate(self.pieces) if p == "</s>")
        self.byte_ids = [0] * 256
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        runs = {p for p in self.score if set(p) == {MARK} and len(p) > 1}
        words = [p for p in self.score if p not in runs]
        if any(MARK in p[1:] for p in words) or any(len({*runs, p} & {p}) for p in runs if self.score[p] > min(self.score[w] for w in words)):
            raise ValueError("the space mark is not confined to the start of pieces")
        self.runs = runs
        self.order = {p: -self.score[p] for p in words}
        self.left: dict[int, list[tuple[str, float]]] = {}
        self.right: dict[int, list[tuple[str, float]]] = {}
        automaton = ahocorasick.Automaton()
        for p in sorted(words, key=len):
            if self._edges(p):
                automaton.add_word(p, (self.ids[p], len(p)))
        automaton.make_automaton()
        self.automaton = automaton
        self.lengths = [len(p) for p in self.pieces]
        #: What each id, written as text, says in UTF-8; byte pieces say one byte, control ids nothing.
        says = {BYTE: lambda p: bytes([int(p[3:5], 16)]), NORMAL: lambda p: p.replace(MARK, " ").encode(), UNKNOWN: lambda p: " \u2047 ".encode()}
        self.says = {str(i): says[k](p) if k in says else b"" for i, (p, k) in enumerate(zip(self.pieces, kinds))}
        self.compatible: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        self.known_before: dict[str, str] = {}
        self.run_ids: dict[int, list[int]] = {}

    def forget(self) -> None:
        """Drop what was remembered of texts, so that an idle worker holds the model alone."""
        self.known, self.known_before, self.run_ids = {}, {}, {}
        if len(self.compatible) > 500_000:
            self.compatible.clear()

    def _edges(self, piece: str) -> bool:
        """Learn what stands at the piece's borders while merges build it; False if merges build something else.

        Each border has a list of (symbol, when it is merged into the next); the
        piece itself is merged never.
        """
        parts, never = list(piece), float("inf")
        left, right = [], []
        while len(parts) > 1:
            when, at = min((self.order.get(parts[i] + parts[i + 1], never), i) for i in range(len(parts) - 1))
            if when == never:
                return False
            if at == 0:
                left.append((parts[0], when))
            if at == len(parts) - 2:
                right.append((parts[-1], when))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        i = self.ids[piece]
        self.left[i], self.right[i] = [*left, (piece, never)], [*right, (piece, never)]
        times = [w for _, w in left], [w for _, w in right]
        if any(t != sorted(t) for t in times):
            raise ValueError(f"merges do not build {piece!r} in order of score")
        return True

    def _fits(self, first: int, second: int) -> bool:
        """Whether both tokens survive side by side.

        A merge across the border runs at its own time if both symbols still stand
        there; at equal times the merge further left runs first.
        """
        order = self.order
        for a, gone_a in self.right[first]:
            for b, gone_b in self.left[second]:
                when = order.get(a + b)
                if when is not None and when < gone_a and when <= gone_b:
                    return False
        return True

    def _stretch(self, text: str) -> list[int]:
        """Ids of a stretch; the mark stands at its start or nowhere."""
        n = len(text)
        last, compatible = [-1] * (n + 1), self.compatible
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length] if end > length else -1
            if before >= 0:
                key = before << 32 | token
                fits = compatible.get(key)
                if fits is None:
                    if len(compatible) > 2_000_000:
                        compatible.clear()
                    fits = compatible[key] = self._fits(before, token)
                if not fits:
                    continue
            last[end] = token
        out: list[int] = []
        while n:
            token = last[n]
            if token >= 0:
                out.append(token)
                n -= self.lengths[token]
            else:  # in no piece: the bytes of the character
                n -= 1
                out.extend(self.byte_ids[b] for b in reversed(text[n].encode()))
        return out[::-1]

    def _run(self, length: int) -> list[int]:
        """Ids of a run of marks: all merges have one score, so the leftmost possible one is next, always."""
        if length not in self.run_ids:
            parts: list[int] = []
            for _ in range(length):
                parts.append(1)
                # what stands left of the newest mark is already settled, so only the end can change
                while len(parts) > 1 and MARK * (parts[-2] + parts[-1]) in self.runs:
                    parts[-2:] = [parts[-2] + parts[-1]]
            if len(self.run_ids) > 10_000:
                self.run_ids.clear()
            self.run_ids[length] = [self.ids[MARK * n] for n in parts]
        return self.run_ids[length]

    def _ids(self, key: str) -> str:
        """Ids, as text, of a stretch: what follows a mark, or, behind a line feed, what follows none."""
        found = self.known_before.get(key)
        if found is None:
            if key[:1] == "\n":
                ids = self._stretch(key[1:])
            else:
                word = key.lstrip(MARK)
                marks = len(key) - len(word) + 1
                ids = self._stretch(MARK + word) if word else []
                if word and ids[0] != self.ids[MARK]:
                    ids = self._run(marks - 1) + ids
                else:
                    ids = self._run(marks) + ids[1:]
            found = " ".join(map(str, ids))
        if len(key) <= KEPT_LENGTH:
            if len(self.known) >= KEPT:
                self.known, self.known_before = {}, self.known
            self.known[key] = found
        return found

    def encode_text(self, text: str) -> str:
        """Ids joined by spaces, with the end id."""
        end = str(self.end_id)
        if not text:
            return end
        out: list[str] = []
        marked = MARK + text.replace(" ", MARK)
        whole = "\n" in self.ids  # the line feed is a piece like others, so lines are no stretches
        feed = str(self.byte_ids[10])
        for k, line in enumerate([marked] if whole else marked.split("\n")):
            if k:
                out.append(feed)
            head, *rest = self._marked(line) if MARK + MARK in line else line.split(MARK)
            make = self._ids
            if head:
                head = "\n" + head
                out.append(self.known.get(head) or make(head))
            known = self.known
            for w in rest:
                ids = known.get(w)
                if ids is None:
                    ids = make(w)
                    known = self.known
                out.append(ids)
        out.append(end)
        return " ".join(out)

    def decode_text(self, ids: str) -> str:
        """The text of ids joined by spaces."""
        pieces = ids.split(" ")
        try:
            text = b"".join(map(self.says.__getitem__, pieces)).decode()
        except UnicodeDecodeError:  # some bytes spell nothing
            return self.decode([int(i) for i in pieces])
        if not text.startswith(" "):
            return text
        first = next((i for i in map(int, pieces) if self.kinds[i] != CONTROL), None)
        return text[1:] if first is not None and self.pieces[first].startswith(MARK) else text

    @staticmethod
    def _marked(line: str) -> list[str]:
        """Split before marks where runs of several occur; a run stays with what follows it."""
        out, words = [], line.split(MARK)
        out.append(words[0])
        run = 0
        for w in words[1:-1]:
            if w:
                out.append(MARK * run + w)
                run = 0
            else:
                run += 1
        out.append(MARK * run + words[-1])
        return out

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        ids = [int(i) for i in self.encode_text(text or "").split()]
        return ids if end else ids[:-1]

    def pieces_text(self, ids: list[int]) -> str:
        """Pieces with marks as spaces, byte pieces as the characters they spell; control ids say nothing."""
        out, raw = [], bytearray()
        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(_spelt(raw))
                raw = bytearray()
            if kind == NORMAL:
                out.append(self.pieces[i].replace(MARK, " "))
            elif kind == UNKNOWN:
                out.append(" ⁇ ")
        if raw:
            out.append(_spelt(raw))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.pieces_text(ids)
        first = next((self.pieces[i] for i in ids if self.kinds[i] != CONTROL), "")
        return text[1:] if first.startswith(MARK) else text


def _spelt(raw: bytearray) -> str:
    """Bytes as UTF-8; a byte that spells nothing becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, k = [], 0
        while k < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[k : k + size].decode())
                    k += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                k += 1
        return "".join(out)


@lru_cache(maxsize=2)
def _table(model: bytes) -> PieceTable:
    return PieceTable(model)


def load_model(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read()
    if len(model) > 64 << 20:
        raise ValueError("a model of over 64 MB is not sent to every task")
    return model


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """Encode every whole text with an end id, decode the ids again, and digest both.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256, and with keep_ids or
    keep_text also ids array<int>, decoded. A null text counts as empty and gives
    the end id alone; other columns and their names don't matter; repeated rows give
    repeated results. One narrow pass: no shuffle, and memory is one batch and one
    worker's table of stretches. The model, of at most 64 MB, is broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_model(model_path))
    id_type = docs.schema[id_col].dataType.simpleString()
    extra = ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared.value)
        for batch in batches:
            cols: list[list] = [[] for _ in range(3 + keep_ids + keep_text)]
            for text in batch.column(1):
                ids = table.encode_text(text.as_py() or "")
                decoded = table.decode_text(ids)
                row = [ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                row += [np.array(ids.split(), np.int32)] if keep_ids else []
                row += [decoded] if keep_text else []
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int32())] * keep_ids, *[pa.string()] * keep_text]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids, *["decoded"] * keep_text]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)
        table.forget()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the decoded text of an id array; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(load_model(model_path))

    @F.pandas_udf("string")
    def decode(ids):
        table = _table(shared.value)
        return ids.map(lambda x: None if x is None else table.decode([int(i) for i in x]))

    return rows.withColumn(out_col, decode(F.col(ids_col)))
