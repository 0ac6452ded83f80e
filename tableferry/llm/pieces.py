"""SentencePiece BPE with a merge-type prefix table.

The table holds, for every prefix of a piece of text, the last token of the
prefix's encoding. That token is unique: of the vocabulary tokens that end
there (found by an Aho-Corasick automaton), it is the one whose pair with the
last token of the prefix before it encodes back to that very pair. Ids are then
read backwards from the end. Pair tests are remembered; each is decided by
merging the two tokens' characters alone.

A text is cut before every space mark that follows another character, since no
token holds a mark behind other characters, and where else no token can reach across. Runs of space marks merge last, at
equal scores, so they are merged from the left on their own.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm.common import PieceCache, ship, slices, whole_text

MARK = "▁"
PAIR_LIMIT = 2_000_000

# Between chunks while a batch is cut; texts that hold it themselves are cut one by one.
_CUT = "\x00"
_LETTER = "A-Za-zÀ-ɏ"
_STOP = f"([{_LETTER}])([.,])"


class PrefixTableBpe:
    """Encoder and decoder for a byte-fallback BPE model file of sentencepiece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.special = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        self.byte_of = {i: int(model.id_to_piece(i)[3:5], 16) for i in range(n) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.id = {p: i for i, p in enumerate(self.piece) if not self.special[i] and i not in self.byte_of}
        self.score = {p: model.get_score(i) for p, i in self.id.items()}
        self.unknown = model.unk_id()
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            if MARK * 2 not in p:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.cut_stops = not any(map(re.compile(_STOP).search, self.id))
        self.pairs: dict[int, bool] = {}
        self.runs: dict[int, list[int]] = {}
        self.cache = PieceCache(lambda pieces: [self.chunk(p.replace(" ", MARK)) for p in pieces])
        surface = [(" ⁇ ".encode() if i == self.unknown else b"") if s else bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode() for i, (p, s) in enumerate(zip(self.piece, self.special, strict=True))]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size

    def merge(self, text: str) -> list[str]:
        """Best-scoring merges first, leftmost of equals: the definition, for short strings."""
        parts = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts) and (whole := parts[a] + parts[b]) in self.score:
                heapq.heappush(heap, (-self.score[whole], a, whole))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, whole = heapq.heappop(heap)
            b = right[a]
            if not parts[a] or b >= len(parts) or parts[a] + parts[b] != whole:
                continue
            parts[a], parts[b], right[a] = whole, "", right[b]
            if right[b] < len(parts):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p]

    def compatible(self, first: int, second: int) -> bool:
        """True if the two tokens' characters encode to exactly these two (first < 0: the second alone)."""
        key = (first + 1) << 20 | second
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > PAIR_LIMIT:
                self.pairs.clear()
            want = [self.piece[second]] if first < 0 else [self.piece[first], self.piece[second]]
            found = self.pairs[key] = self.merge("".join(want)) == want
        return found

    def word(self, text: str) -> list[int]:
        """Ids of a text with at most one space mark, at its start."""
        size = len(text)
        last: list[int] = [-2] * size  # of the prefix that ends here; -2: none yet
        length = [1] * size
        pairs = self.pairs
        for end, (token, n) in self.automaton.iter(text):
            if last[end] != -2:
                continue
            start = end - n
            before = last[start] if start >= 0 else -1
            if before == -2:
                before = -1  # a character outside the vocabulary: nothing merges across it
            fits = pairs.get((before + 1) << 20 | token)
            if fits is None:
                fits = self.compatible(before, token)
            if fits:
                last[end], length[end] = token, n
        ids: list[int] = []
        at = size - 1
        while at >= 0:
            if last[at] == -2:
                ids.extend(self.byte_id.get(b, self.unknown) for b in reversed(text[at].encode()))
            else:
                ids.append(last[at])
            at -= length[at]
        return ids[::-1]

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` space marks."""
        if n not in self.runs:
            if n > 4096:
                return [self.id[p] for p in self.merge(MARK * n)]
            self.runs[n] = [self.id[p] for p in self.merge(MARK * n)]
        return self.runs[n]

    def chunk(self, text: str) -> list[int]:
        """Ids of a run of space marks followed by other characters."""
        marks = len(text) - len(text.lstrip(MARK))
        if marks == 0:
            return self.word(text)
        if marks == len(text):
            return self.run(marks)
        ids = self.word(text[marks - 1 :])
        if ids[0] == self.id.get(MARK):  # the mark next to the word stayed alone, so it joins the run
            return (self.run(marks) if marks > 1 else ids[:1]) + ids[1:]
        return (self.run(marks - 1) if marks > 1 else []) + ids

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin and end."""
        if pc.any(pc.match_substring(texts, _CUT)).as_py():
            lists = pa.array([_chunks(t) for t in texts.to_pylist()], pa.list_(pa.string()))
            return self.cache.look_up_lists(lists)
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", pc.replace_substring(texts, MARK, " "), ""))
        marked = pc.replace_substring_regex(marked, "([^ ]) ", f"\\1{_CUT} ")
        if self.cut_stops:
            marked = pc.replace_substring_regex(marked, _STOP, f"\\1{_CUT}\\2")
        return self.cache.look_up_lists(pc.split_pattern(marked, _CUT))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; the space that encoding puts in front is taken off."""
        ids = np.asarray(ids, np.int64)
        size = self.surface_size[ids]
        starts = np.repeat(self.surface_start[ids] - (np.cumsum(size) - size), size)
        data = self.surface[starts + np.arange(len(starts))].tobytes()
        shown = next((int(i) for i in ids if not self.special[i] or i == self.unknown), self.unknown)
        if shown != self.unknown and shown not in self.byte_of and data[:1] == b" ":
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _each_bad_byte(data)


def _chunks(text: str) -> list[str]:
    """A text with the mark in front, cut before every run of marks."""
    return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", MARK + text.replace(" ", MARK)) if text else []


def _each_bad_byte(data: bytes) -> str:
    """UTF-8 with one replacement character per byte that is no part of a character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as bad:
            out.append(data[at : at + bad.start].decode() + "�")
            at += bad.start + 1
    return "".join(out)


_loaded: dict[str, PrefixTableBpe] = {}


def loaded(path: str) -> PrefixTableBpe:
    """The encoder of a model file, built once per Python process."""
    if path not in _loaded:
        _loaded[path] = PrefixTableBpe(path)
    return _loaded[path]


def encode_frame(docs: DataFrame, model_path: str, text: str = "text", payload: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``payload`` columns plus ``ids`` (array of int) and ``decoded`` (text of those ids) for every row.

    A null or empty text has no ids and decodes to the empty text. Rows are
    independent, so nothing is shuffled; a very long text is held once with its
    ids in the task that reads it.
    """
    ship(docs.sparkSession)
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("row"), whole_text(text).alias("text"))
    schema = T.StructType([source.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(model_path)
        for batch in slices(batches, "text"):
            ids, ends = bpe.encode_all(batch.column("text"))
            decoded = [bpe.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists, pa.array(decoded, pa.string())], names=["row", "ids", "decoded"])

    return source.mapInArrow(run, schema).select("row.*", "ids", "decoded")
