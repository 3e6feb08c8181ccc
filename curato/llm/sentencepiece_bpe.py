"""SentencePiece BPE encoding by a prefix table of last tokens, and decoding.

A merge-type (BPE) model starts from single characters and keeps joining the
adjacent pair whose joined piece has the highest score (the leftmost of equal
ones).  The result is unique, and so is the last token of every prefix's
result: cut the last token off and the rest is the result of the shorter
prefix.

Method.  An automaton over the vocabulary's pieces gives, at each position, all
pieces that end there.  For each (longest first) the table entry at the piece's
start is the token that would precede it; the two are accepted when they are
compatible, that is when merging their joined text alone gives just these two
tokens.  Merges inside two neighbouring tokens never depend on what lies
around them, so compatible neighbours throughout make the whole result.  The
accepted token is stored, one per prefix, and the ids are read off backwards
from the end.  A character outside the vocabulary takes part in no merge: it
ends one table and is written as its byte tokens.

Words.  No piece of the vocabulary (checked when it is loaded) has a space
mark after another character, so a text is cut before each run of space marks
and equal words are encoded once per worker; the memory of words is bounded.

Defined cases.  A null text is the empty text; the empty text gives only the
begin and end ids and decodes to the empty text.  Ids outside the vocabulary
raise.  Texts of any length take memory in proportion to themselves.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from curato.llm.common import freed, table

SPACE_MARK = "▁"
BEGIN, END, UNKNOWN = 1, 2, 0
CACHED_WORDS = 300_000   # about 200 bytes each, per worker
CACHED_PAIRS = 300_000
OUTPUT_BYTES = 8 << 20  # of kept ids and texts before a batch goes out
SHORT_WORD = 64  # longer units are not kept in the memory of words


class PrefixBpe:
    """Encoder and decoder of one merge-type vocabulary."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.pieces: list[str] = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_of: list[bytes | None] = []
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.silent: set[int] = set()
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i):
                self.silent.add(i)
                self.bytes_of.append(b"")
            elif model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.id_of[piece], self.score[piece] = i, model.get_score(i)
                self.bytes_of.append(piece.replace(SPACE_MARK, " ").encode())
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in self.score):
            raise ValueError("a piece crosses a word's start")
        self.alphabet = {p for p in self.score if len(p) == 1}
        if not set("".join(self.score)) <= self.alphabet:
            raise ValueError("a piece holds a character that is no piece")
        self.is_byte = [model.is_byte(i) for i in range(len(self.pieces))]
        self.pairs: dict[int, bool] = {}  # left << 20 | right
        self.words: dict[str, bytes] = {}
        self.changed: dict[str, bytes] = {}   # words whose ids decode to something else than the word
        # Pieces that merging can reach: those that their own text encodes to.
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if len(piece) == 1 or self._merge(piece) == [i]:
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()

    def _merge(self, text: str) -> list[int]:
        """The definition itself, for the short texts of pair tests: join the best pair again and again."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.id_of[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 20 | right)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self._merge(self.pieces[left] + self.pieces[right]) == [left, right]
            self.pairs[left << 20 | right] = known
        return known

    def encode_marked(self, text: str) -> list[int]:
        """Ids of a text whose spaces are space marks already."""
        last = [-1] * (len(text) + 1)   # the last token of each prefix; -1 before any
        length = [1] * (len(text) + 1)
        pairs, compatible = self.pairs, self.compatible
        # Every piece in the text by its end, the longest of an end first.
        for at, (size, token) in self.automaton.iter(text):
            at += 1
            if last[at] < 0:
                before = last[at - size]
                if before >= 0:
                    fits = pairs.get(before << 20 | token)
                    if not (compatible(before, token) if fits is None else fits):
                        continue
                last[at], length[at] = token, size
        ids, at = [], len(text)
        while at:
            token = last[at]
            if token >= 0:
                ids.append(token)
            else:  # outside the vocabulary: its bytes
                ids.extend([self.byte_ids[b] for b in reversed(text[at - 1].encode())])
            at -= length[at]
        ids.reverse()
        return ids

    def _word(self, word: str) -> bytes:
        ids = self.encode_marked(word)
        made, decoded = pack(ids), b"".join([self.bytes_of[i] for i in ids])
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
            self.changed.clear()
        if decoded != word.replace(SPACE_MARK, " ").encode():
            self.changed[word] = decoded
        if len(word) <= SHORT_WORD:
            self.words[word] = made
        return made

    def units(self, text: str) -> list[str]:
        """The marked text cut before each run of space marks, and before and
        after each line feed that is no piece."""
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK) if text else ""
        return _UNITS.findall(marked) if "\n" not in self.alphabet else _WORDS.findall(marked)

    def round_trip(self, text: str) -> tuple[bytes, bytes]:
        """(packed ids, UTF-8 text that they decode to).

        All bytes of a character come from one word, so a text's ids decode to
        what its words' ids decode to, one after the other.  Each word's ids
        are decoded when the word is encoded, and the outcome is kept only
        where it differs from the word; the first piece loses the space mark
        that every text gets."""
        words, make, units = self.words, self._word, self.units(text)
        packed = b"".join([words.get(unit) or make(unit) for unit in units])
        if self.changed and not self.changed.keys().isdisjoint(units):
            raw = b"".join([self.changed.get(u) or u.replace(SPACE_MARK, " ").encode() for u in units])
        else:
            raw = "".join(units).replace(SPACE_MARK, " ").encode()
        return packed, raw[1:] if raw[:1] == b" " else raw

    def encode(self, text: str) -> list[int]:
        return [BEGIN, *unpack(self.round_trip(text)[0]), END]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of any ids: control ids are silent, the first piece loses one
        leading space, bytes that form no character become U+FFFD one by one."""
        out, pending, first = [], bytearray(), True
        for i in ids:
            if not 0 <= i < len(self.pieces):
                raise ValueError(f"no such id: {i}")
            if i in self.silent:
                out.append(text_of(bytes(pending)))  # bytes on its two sides form no character
                pending.clear()
                continue
            if self.is_byte[i]:
                pending += self.bytes_of[i]
                first = False
                continue
            out.append(text_of(bytes(pending)))
            pending.clear()
            piece = self.bytes_of[i].decode()
            out.append(piece[1:] if first and i != UNKNOWN and piece.startswith(" ") else piece)
            first = False
        out.append(text_of(bytes(pending)))
        return "".join(out)


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def unpack(packed: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(packed) // 4}I", packed)


# A run of marks with the word after it, or a line feed.
_UNITS = re.compile(f"\n|{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+")
_WORDS = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")


def text_of(raw: bytes) -> str:
    """UTF-8 text; each byte that belongs to no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


_LOADED: dict[str, PrefixBpe] = {}


def tokenizer(model_path: str) -> PrefixBpe:
    """One encoder per worker and model."""
    if model_path not in _LOADED:
        _LOADED[model_path] = PrefixBpe(model_path)
    return _LOADED[model_path]


def encode_documents(docs: DataFrame, model_path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Per document: doc_id, n_tokens, the digests of its ids and of its decoded
    text, and of ``keep`` ("ids", "decoded") the ids and the decoded text themselves."""
    kinds = {"ids": "array<int>", "decoded": "string"}
    if not set(keep) <= set(kinds):
        raise ValueError(f"not kept: {keep}")
    kept = [k for k in kinds if k in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(model_path)
        begin, end = pack([BEGIN]), pack([END])
        for batch in freed(batches):
            made: list[tuple[int, str, str]] = []
            ids, texts, held, first = [], [], 0, 0

            def flush() -> pa.RecordBatch:
                columns = [batch.column("doc_id").slice(first, len(made)), *(
                    pa.array([m[i] for m in made], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string())))]
                for k in kept:
                    if k == "ids":
                        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                        columns.append(pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))))
                    else:
                        columns.append(pa.array(texts, pa.string()))
                return pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *kept])

            for n, value in enumerate(batch.column("text")):
                packed, decoded = bpe.round_trip(value.as_py() or "")
                whole = begin + packed + end
                made.append((len(whole) // 4, hashlib.sha256(whole).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                if "ids" in kept:
                    ids.append(whole)
                    held += len(whole)
                if "decoded" in kept:
                    texts.append(decoded.decode())
                    held += len(decoded)
                if held >= OUTPUT_BYTES:
                    yield flush()
                    made, ids, texts, held, first = [], [], [], 0, n + 1
            if made or not len(batch):
                yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = "".join(f", {k} {kinds[k]}" for k in kept)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), default_model())
