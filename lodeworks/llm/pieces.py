"""SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes symbols, one per character, with a word-start mark for each space and one in front.
An agenda holds every adjacent pair that forms a known piece, best score first and leftmost first
among equals; the best pair is merged and its new neighbours are entered, until the agenda is empty.
Characters outside the vocabulary become their UTF-8 bytes' pieces. Decoding turns ids back to text.

No piece of such a vocabulary continues past the start of a word, so each word (its marks and the
characters behind them) is encoded by itself and remembered. Every distinct word of an Arrow batch is
checked against the library before it is used, ids and decoded text; a difference is an error. If a
vocabulary has pieces that do span words, whole texts are encoded and checked instead.

A null or empty text has no ids and decodes to the empty text. Repeated rows are encoded alike; other
input columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*")

_NO_PIECE = float("-inf")
#: Longest word, in characters, whose agenda is a list; beyond it is a heap.
SHORT = 64

#: Remembered words per worker; when full, the memory starts afresh.
WORDS_KEPT = 600_000
#: Texts are encoded in groups of about this many characters.
GROUP_CHARS = 500_000


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id, self.text = {}, {}, []
        self.bytes = {}
        for k in range(library.get_piece_size()):
            piece = library.id_to_piece(k)
            plain = not (library.is_control(k) or library.is_unknown(k) or library.is_byte(k))
            self.text.append(piece if plain else "")
            if library.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
            elif plain:
                self.score[piece], self.id[piece] = library.get_score(k), k
        self.byte_of = {k: b for b, k in self.bytes.items()}
        self.unknown = library.unk_id()
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece in self.id)
        self.known: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}  # words that do not come back as they were

    def encode(self, marked: str) -> list[int]:
        """Ids of a text whose spaces are already marks."""
        symbols = list(marked)
        n = len(symbols)
        score = self.score
        if n <= SHORT:
            # Few pairs: the agenda is a plain list by place, its best entry found by max().
            get = score.get
            agenda = [get(a + b, _NO_PIECE) for a, b in zip(symbols, symbols[1:])]
            while agenda:
                best = max(agenda)
                if best == _NO_PIECE:
                    break
                k = agenda.index(best)
                joined = symbols[k] + symbols.pop(k + 1)
                symbols[k] = joined
                del agenda[k]
                if k < len(agenda):
                    agenda[k] = get(joined + symbols[k + 1], _NO_PIECE)
                if k:
                    agenda[k - 1] = get(symbols[k - 1] + joined, _NO_PIECE)
            return self._ids(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for k in range(n - 1):
            value = score.get(symbols[k] + symbols[k + 1])
            if value is not None:
                agenda.append((-value, k, symbols[k], symbols[k + 1]))
        heapq.heapify(agenda)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            # Stale if either side has been merged since.
            if symbols[left] != a or right < 0 or symbols[right] != b:
                continue
            symbols[left] = joined = a + b
            symbols[right] = ""
            after[left] = follow = after[right]
            if follow >= 0:
                before[follow] = left
                value = score.get(joined + symbols[follow])
                if value is not None:
                    heapq.heappush(agenda, (-value, left, joined, symbols[follow]))
            lead = before[left]
            if lead >= 0:
                value = score.get(symbols[lead] + joined)
                if value is not None:
                    heapq.heappush(agenda, (-value, lead, symbols[lead], joined))
        return self._ids([s for s in symbols if s])

    def _ids(self, symbols: list[str]) -> list[int]:
        out = []
        for s in symbols:
            k = self.id.get(s)
            if k is not None:
                out.append(k)
            else:
                out.extend(self.bytes.get(b, self.unknown) for b in s.encode())
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, with the mark in front still there as a space."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.text[k] for k in ids]).replace(MARK, " ")
        parts, held = [], bytearray()
        for k in ids:
            byte = self.byte_of.get(k)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                parts.append(held.decode("utf-8", "replace"))
                held = bytearray()
            parts.append(self.text[k])
        if held:
            parts.append(held.decode("utf-8", "replace"))
        return "".join(parts).replace(MARK, " ")

    def learn(self, words: list[str]) -> None:
        """Encode and decode new words, hold both against the library, and remember them."""
        plain = [w[1:].replace(MARK, " ") for w in words]
        theirs = self.library.encode(plain, num_threads=1)
        back = self.library.decode(theirs, num_threads=1)
        for word, want, text in zip(words, theirs, back, strict=True):
            ids = self.encode(word)
            own = self.decode(ids)
            if word == MARK:  # nothing is left to ask for without the mark that the library adds
                want = [self.id[MARK]]
            if ids != want or own[1:] != text:
                raise ValueError(f"encoding differs from the library's: {word!r}: {ids} and {want}")
            self.known[word] = pack(f"{len(ids)}i", *ids)
            if own != word.replace(MARK, " "):
                self.changed[word] = own

    def both(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as 32-bit integers, decoded text) of each text."""
        split = []
        for t in texts:
            marked = MARK + t.replace(" ", MARK) if t else ""
            split.append(_WORD.findall(marked) if self.by_word else [marked] if t else [])
        new = list({w for words in split for w in words if w not in self.known})
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known, self.changed = {}, {}
            new = list({w for words in split for w in words})
        self.learn(new)
        known, out = self.known, []
        for words in split:
            ids = b"".join([known[w] for w in words])
            changed = self.changed and not self.changed.keys().isdisjoint(words)
            text = "".join([self.changed.get(w, w) for w in words] if changed else words)
            out.append((ids, text[1:].replace(MARK, " ")))
        return out


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id, ``ids`` (array of int) and ``decoded`` (string).

    ``model_path`` must name the vocabulary file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in batches:
            at, sizes = 0, np.asarray([0 if n is None else n for n in batch.column(2).to_pylist()])
            while at < batch.num_rows:
                stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), GROUP_CHARS)))
                part = batch.slice(at, stop - at)
                done = pieces.both([t or "" for t in part.column(1).to_pylist()])
                lengths = np.cumsum([0] + [len(ids) // 4 for ids, _ in done])
                values = np.frombuffer(b"".join([ids for ids, _ in done]), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(values)), pa.array([t for _, t in done], pa.string())],
                    ["id", "ids", "decoded"],
                )
                at = stop

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.length(text_col).alias("n"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
