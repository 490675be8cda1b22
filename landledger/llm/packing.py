"""Token sequences packed online by the sum-of-squares rule."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.text_tables import ids_and_texts

CAPACITY = 4096
END_ID = 2
OPEN_WINDOWS = 2_048  # partly filled windows a task holds before it closes them
SLICE_BYTES = 16 << 20  # text that is tokenised at once
WORDS_A_CALL = 10_000
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
MOST_KNOWN = 500_000  # words whose ids a worker process keeps from slice to slice
_TOKENIZERS: dict[str, _Words] = {}


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of ``capacity`` tokens: doc_id, start, length, doc_tokens, sequence_id,
    offset, ids.

    A document is the ids of its text (without special tokens) and ``end_id``. ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit numbers, ``start`` counts the document's ids before the piece, ``offset`` those of
    the sequence before it. ``sequences`` puts the pieces together.

    Documents come online, one after another. What exceeds a window is cut off in whole windows; the rest goes to
    the level (fill of a partly filled window, or a new one) that makes the sum of the squared counts of
    windows by level least, the fullest of equal ones. An array holds the count of each level, 0 to ``capacity``. Windows that are
    full leave the task at once. At its end, or when ``OPEN_WINDOWS`` are open, the emptiest windows are cut to
    fill the fullest, and the last one is cut to sequences whose lengths are powers of two, which need no
    padding. So no token is padding, and only documents of the closing windows are cut without need.

    Every partition of ``docs`` is packed where it lies: nothing is shuffled, a hot source or group of copies makes
    no difference, and sequence ids begin with the partition's number. A task that is run again gives the same
    pieces if its rows come in the same order, as those of a stored table do; store other inputs first.
    Memory: a slice of text, the ids of ``MOST_KNOWN`` words and of ``OPEN_WINDOWS`` windows, and those of one document.

    The tokenizer file is read on the driver and broadcast (its size is its vocabulary's, some megabytes). Texts
    are cut at ASCII white space and distinct words are tokenised once a slice; a tokenizer that joins words across
    blanks raises an error at the first text of a task where it shows.

    A null or empty text is its end id alone; a null doc_id is kept; repeated rows are separate documents. An
    empty table gives no rows. Other columns are not read.
    """
    if capacity < 2:
        raise ValueError("capacity must be 2 at least")
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(shared.value)
        packer = _Packer(capacity, TaskContext.get().partitionId() << 40)
        tested = False
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            if not tested and batch.num_rows:
                _test_words(words, texts[0].as_py())
                tested = True
            for row, ids, offsets in _token_slices(texts, words):
                for i in range(len(offsets) - 1):
                    packer.add(doc_ids[row + i], np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(end_id)))
                if packer.done:
                    yield packer.batch()
        packer.close()
        if packer.done:
            yield packer.batch()

    return map_arrow(ids_and_texts(docs, id_column, text_column), packed, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, tokens, doc_ids, ids: each sequence's pieces in the order of their offsets, at most a window a row."""
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("own"))
    return rows.select(
        "sequence_id", "tokens", F.transform("own", lambda p: p["doc_id"]).alias("doc_ids"),
        F.aggregate("own", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
    )


class _Words:
    """Ids of words: those seen first are kept, up to ``MOST_KNOWN``, the others are tokenised again in each slice."""

    def __init__(self, content: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.known = pa.array([], pa.large_string())
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct ``words`` the place of its first id and their number."""
        words = words.cast(pa.large_string())
        at = pc.index_in(words, self.known)
        new = words.filter(at.is_null())
        new_ids, new_sizes = self._tokenise(new.to_pylist())
        ids, sizes = np.concatenate([self.ids, new_ids]), np.concatenate([self.sizes, new_sizes])
        place = at.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(new))
        keep = min(len(new), MOST_KNOWN - len(self.known))
        if keep > 0:
            self.known = pa.concat_arrays([self.known, new.slice(0, keep)])
            self.sizes = sizes[: len(self.known)].copy()
            self.ids = ids[: self.sizes.sum()].copy()
        return ids, (np.cumsum(sizes) - sizes)[place], sizes[place]

    def _tokenise(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(words), WORDS_A_CALL):
            some = words[i : i + WORDS_A_CALL]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(sizes)


def _words(content: str) -> _Words:
    """The tokenizer of a file's content, built once a worker process."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = _Words(content)
    return _TOKENIZERS[key]


def _test_words(words: _Words, text: str) -> None:
    """Raise if the words of a text have other ids alone than in the text (its first 64 KB, cut at a blank)."""
    if len(text) > 1 << 16:
        text = text[: 1 << 16].rsplit(" ", 1)[0]
    ids, _ = _encode(pa.array([text], pa.large_string()), words)
    if ids.tolist() != words.tokenizer.encode(text, add_special_tokens=False).ids:
        raise ValueError("this tokenizer joins words across white space; their ids cannot be looked up word by word")


def _encode(texts: pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and the offsets of each text in them."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    ids, first, sizes = words.ids_of(coded.dictionary)
    at = coded.indices.to_numpy(zero_copy_only=False)
    lengths = sizes[at]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    gathered = ids[np.arange(ends[-1]) + np.repeat(first[at] - ends[:-1], lengths)]
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    return gathered, ends[offsets]


def _token_slices(texts: pa.Array, words: _Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets by row) of slices of about ``SLICE_BYTES``; a longer text is cut at blanks."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        before = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        if int(ends[stop - 1]) - before <= SLICE_BYTES:
            yield row, *_encode(texts.slice(row, stop - row), words)
        else:
            ids = np.concatenate([_encode(part, words)[0] for part in _parts(texts[row].as_buffer())])
            yield row, ids, np.array([0, len(ids)])
        row = stop


def _parts(text: pa.Buffer) -> Iterator[pa.Array]:
    """A long text in parts of about ``SLICE_BYTES`` that end at white space."""
    data = np.frombuffer(text, np.uint8)
    begin = 0
    while begin < len(data):
        end = min(begin + SLICE_BYTES, len(data))
        while end < len(data):
            gaps = np.flatnonzero(_SPACE[data[end : end + 65_536]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + 65_536, len(data))
        yield pa.array([data[begin:end].tobytes()], pa.large_binary()).cast(pa.large_string())
        begin = end


class _Packer:
    """The windows of one task: full ones as finished pieces, the others by level."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next = capacity, first_sequence
        self.counts = np.zeros(capacity + 1, np.int64)  # the level array; full windows do not count
        self.windows: dict[int, list[list[tuple]]] = {}  # windows of each level
        self.open = 0
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc_id, start, len(ids), ids[start : start + self.capacity])])
        if whole < len(ids):
            self._place((doc_id, whole, len(ids), ids[whole:].copy()))

    def _place(self, piece: tuple) -> None:
        size, counts = len(piece[3]), self.counts
        # half the change of the sum of squares when a window of level h gets the piece, less the same 1 for each
        here = counts[1 : self.capacity - size + 1]
        gain = 2 * (counts[size + 1 :] - here) + 1
        if len(gain):
            gain[-1] -= 1  # a window that becomes full leaves the sum
        gain = np.where(here > 0, gain, np.iinfo(np.int64).max)
        best = len(gain) - 1 - int(np.argmin(gain[::-1])) if len(gain) else -1
        if best >= 0 and gain[best] <= 2 * counts[size]:
            level = best + 1
            counts[level] -= 1
            window = self.windows[level].pop()
            self.open -= 1
        else:
            level, window = 0, []
        window.append(piece)
        level += size
        if level == self.capacity:
            self._emit(window)
            return
        counts[level] += 1
        self.windows.setdefault(level, []).append(window)
        self.open += 1
        if self.open > OPEN_WINDOWS:
            self.close()

    def close(self) -> None:
        """Fill the fullest open windows with what the emptiest hold, and end the last by powers of two."""
        levels = sorted((level for level, own in self.windows.items() if own), reverse=True)
        waiting = [(level, window) for level in levels for window in self.windows[level]]
        self.windows, self.open = {}, 0
        self.counts[:] = 0
        while len(waiting) > 1:
            level, window = waiting.pop(0)
            room = self.capacity - level
            while room and waiting:
                left, giver = waiting.pop()
                piece, rest = _cut(giver.pop(), room)
                window.append(piece)
                room -= len(piece[3])
                left -= len(piece[3])
                if rest is not None:
                    giver.append(rest)
                if left:
                    waiting.append((left, giver))
            if room:
                waiting.append((self.capacity - room, window))
                break
            self._emit(window)
        for level, window in waiting:
            window.reverse()
            for bit in range(level.bit_length() - 1, -1, -1):
                if level >> bit & 1:
                    room, own = 1 << bit, []
                    while room:
                        piece, rest = _cut(window.pop(), room)
                        own.append(piece)
                        room -= len(piece[3])
                        if rest is not None:
                            window.append(rest)
                    self._emit(own)

    def _emit(self, window: list[tuple]) -> None:
        offset = 0
        for doc_id, start, total, ids in window:
            self.done.append((doc_id, start, len(ids), total, self.next, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 6, pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        columns = [pa.array(c, k) for c, k in zip(zip(*self.done), kinds)]
        self.done = []
        return pa.RecordBatch.from_arrays(columns, names=names)


def _cut(piece: tuple, room: int) -> tuple[tuple, tuple | None]:
    """The part of a piece that fits and the rest, if any."""
    doc_id, start, total, ids = piece
    if len(ids) <= room:
        return piece, None
    return (doc_id, start, total, ids[:room]), (doc_id, start + room, total, ids[room:])
