"""SentencePiece encoding that keeps, for every piece, its byte span in the original text.

The text is normalised first: at each place the longest key of the model's compiled
character map that fits is replaced, and for every normalised character the source bytes
are noted. Pieces come from the sentencepiece library; no piece of a usable model has a
word mark behind another character, so words are encoded apart and each task keeps those
it has met. Piece lengths, projected through the alignment, give spans in the original.

Defined results: NULL and empty texts have only the end id, with an empty span.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from pyspark.sql import DataFrame

from riskweave.llm.common import map_rows

MARK = "▁"
KNOWN_WORDS = 400_000  # words a task remembers; then it starts anew


class CharacterMap:
    """The compiled character map of a model: a double-array trie and its replacements.

    The layout is that of the model format: the trie's size in bytes, its 32-bit units,
    then replacements that end with a zero byte.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.values = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length in bytes of the longest key at `at`, and what replaces it."""
        if not self.units:
            return None
        found, unit, node = None, self.units[0], 0
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                v = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.values[v : self.values.index(b"\0", v)].decode()
        return found


class Encoder:
    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.trim = spec.remove_extra_whitespaces
        names = [p.piece for p in proto.pieces]
        plain = {1, 2, 3, 6}  # normal, unknown, control, byte
        self.by_word = (
            spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and all(p.type in plain for p in proto.pieces)
            and not any(re.search(f"[^{MARK}]{MARK}", n) for n in names)
        )
        if not self.by_word:
            raise ValueError("the model's pieces cross word marks; words cannot be encoded apart")
        self.mark_id = self.model.piece_to_id(MARK)
        # Bytes each id covers of the normalised text, the mark counting as one.
        self.width = np.array(
            [1 if p.type in (2, 6) else len(p.piece.replace(MARK, " ").encode()) for p in proto.pieces],
            np.int32,
        )
        self.unknown = self.model.unk_id()
        self.words: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text with spaces for word marks, the added first one left out, and
        for each of its bytes and the end the source byte it comes from (None: the same)."""
        if not self.map.units and not self.trim:
            return (text.replace(MARK, " "), self._marks(text)) if MARK in text else (text, None)
        data, out, source, at = text.encode(), [], [], 0
        while at < len(data):
            hit = self.map.longest(data, at)
            if hit:
                size, new = hit
            else:
                size = next(n for n in range(1, 5) if at + n == len(data) or data[at + n] & 0xC0 != 0x80)
                new = data[at : at + size].decode()
            for char in new.replace(MARK, " "):
                if self.trim and char == " " and (not out or out[-1] == " "):
                    continue
                out.append(char)
                source += [at] * len(char.encode())
            at += size
        while self.trim and out and out[-1] == " ":
            out.pop()
            source.pop()
        return "".join(out), np.array([*source, at], np.int64)

    def _marks(self, text: str) -> np.ndarray:
        widths = np.array([3 if c == MARK else 1 for c in text for _ in range(1 if c == MARK else len(c.encode()))])
        return np.concatenate([[0], np.cumsum(widths)])

    def _learn(self, words: list[str]) -> None:
        for word, ids in zip(words, self.model.encode(words, num_threads=1), strict=True):
            self.words[word] = array("i", ids if word else [self.mark_id]).tobytes()

    def _widths(self, words: list[str], ids: np.ndarray) -> np.ndarray:
        """Bytes of the normalised text that each id covers, the mark counting as one."""
        if self.unknown not in ids:
            return self.width[ids]
        out = []  # an unknown id can cover several characters: take the library's spans
        for word in words:
            ends = [p.end for p in self.model.encode(word, return_type="proto").pieces] or [0]
            out += [ends[0] + 1, *np.diff(ends)]
        return np.array(out, np.int32)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids, and the first byte and the byte after the last of each piece."""
        normal = [self.normalise(t) for t in texts]
        split = []
        for text, _ in normal:
            words = text.split(" ")
            if "" in words:  # runs of spaces stand together in front of the next word
                words = [w[1:] for w in re.findall(" +[^ ]*", " " + text)] if text else []
            split.append(words)
        needed = set().union(*split)
        missing = needed - self.words.keys()
        if len(self.words) + len(missing) > KNOWN_WORDS:
            self.words.clear()
            missing = needed
        if missing:
            self._learn(list(missing))
        out, known = [], self.words
        for words, (_, source) in zip(split, normal):
            ids = np.frombuffer(b"".join([known[w] for w in words]), np.int32)
            end = np.cumsum(self._widths(words, ids), dtype=np.int64) - 1
            begin = np.maximum(np.concatenate([[0], end[:-1]]), 0) if len(ids) else end
            out.append((ids, begin, end) if source is None else (ids, source[begin], source[end]))
        return out


def encode(docs: DataFrame, model_file: str, end_id: bool = True) -> DataFrame:
    """doc_id, ids, begins, ends: the ids of each whole text and their byte spans in it."""

    def make():
        encoder = Encoder(model_file)
        last = encoder.model.eos_id()

        def work(c):
            ids, begins, ends = [], [], []
            for text, (i, a, b) in zip(c["text"], encoder.encode(c["text"])):
                size = len(text.encode()) if end_id else 0
                ids.append(np.append(i, np.int32(last)) if end_id else i)
                begins.append(np.append(a, size) if end_id else a)
                ends.append(np.append(b, size) if end_id else b)
            return {"doc_id": c["doc_id"], "ids": ids, "begins": begins, "ends": ends}

        return work

    return map_rows(
        docs.select("doc_id", "text"),
        make,
        "doc_id bigint, ids array<int>, begins array<int>, ends array<int>",
    )


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """The rows of `encode` with `text`, as the library's decode(ids) gives it."""

    def run(batches):
        import pyarrow as pa
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for batch in batches:
            lists = batch.column(1)
            texts = []
            for a in range(0, batch.num_rows, 64):
                texts += model.decode(lists.slice(a, 64).to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")
