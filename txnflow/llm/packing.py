"""Sum-of-squares online packing of tokenised documents into sequences.

N(h) counts the open sequences filled to level h.  A document goes to the level for which the sum of N(h)^2 over the
partly filled levels is least afterwards (a new sequence is level 0); ties go to the fuller one.  The counts are one
array, so a choice is one vectorised expression over the levels.

* A document longer than a sequence gives whole sequences and a rest, which is packed as above.
* Beyond ``max_open`` open sequences a document is cut to complete the fullest one; its rest is packed as above.
  So the memory of a task is bounded for every distribution of lengths.
* At the end of a partition the fullest open sequences are completed with cuts of the emptiest.  The one that is left
  over is cut into sequences of powers of two, which need no padding.

Every partition packs its own documents; nothing is shuffled.  A sequence's id is made of the partition's number and
the sequence's number in it.  Tokens are those of the whole text plus ``end_id``; a null or empty text is ``end_id``
alone.  Repeated rows are packed as often as they occur.

The tokenizer splits at white space before anything else, so runs of other characters are encoded once and
remembered by the worker process (``memory`` runs at most, then the memory starts anew).
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnflow.llm.common import byte_texts, process_memory, slices


class SumOfSquares:
    """Packs the documents given to :meth:`add`; yields finished sequences as lists of (document, start, ids)."""

    def __init__(self, capacity: int = 2048, max_open: int = 512):
        self.capacity, self.max_open = capacity, max_open
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def _take(self, level: int) -> list:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, pieces: list, level: int) -> None:
        self.levels[level] += 1
        self.n_open += 1
        self.open.setdefault(level, []).append(pieces)

    def best_level(self, size: int) -> int:
        """The level that ``size`` tokens go to; 0 is a new sequence."""
        room = self.capacity - size
        now = self.levels[1 : room + 1]
        change = 2 * (self.levels[1 + size :] - now + 1)
        change[-1:] = 1 - 2 * now[-1:]  # a full sequence is not partly filled
        change = np.where(now > 0, change, np.iinfo(np.int64).max)
        new = 2 * self.levels[size] + 1
        if room and change.min() <= new:
            return room - int(np.argmin(change[::-1]))
        return 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list]:
        start, size = 0, len(ids)
        while size - start >= self.capacity:
            yield [(doc, start, ids[start : start + self.capacity])]
            start += self.capacity
        if start < size and self.n_open >= self.max_open:
            level = int(np.flatnonzero(self.levels)[-1])
            if level + size - start > self.capacity:
                cut = start + self.capacity - level
                yield [*self._take(level), (doc, start, ids[start:cut])]
                start = cut
        if start < size:
            level = self.best_level(size - start)
            rest = ids[start:].copy() if start else ids  # a view would keep the whole document while it waits
            pieces = [*(self._take(level) if level else []), (doc, start, rest)]
            if level + size - start == self.capacity:
                yield pieces
            else:
                self._put(pieces, level + size - start)

    def finish(self) -> Iterator[list]:
        """The rest: open sequences completed with cuts of each other, the last one in powers of two."""
        rest = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        stream = [piece for w in rest for piece in w]
        self.__init__(self.capacity, self.max_open)
        total = sum(len(ids) for _, _, ids in stream)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        yield from cut_stream(stream, sizes)


def cut_stream(stream: list, sizes: Iterable[int]) -> Iterator[list]:
    """The pieces in order, cut to sequences of the given sizes."""
    queue = iter(stream)
    doc, start, ids = None, 0, ()
    for size in sizes:
        pieces, room = [], size
        while room:
            if not len(ids):
                doc, start, ids = next(queue)
            head, ids = ids[:room], ids[room:]
            pieces.append((doc, start, head))
            start += len(head)
            room -= len(head)
        yield pieces


#: Marks that a run may end with; after a letter or digit they are tokens of their own.
MARKS = b".,;:!?"
#: A character that is a token of its own between spaces.
SEPARATOR = "\x1f"


class Runs(dict):
    """Numbers of runs of characters: 8 times the number of the body plus that of a final mark, 0 without one.

    The tokenizer lower-cases and splits before a final mark, so runs that differ in that alone have one body.
    """

    def __init__(self):
        super().__init__()
        self.bodies: dict[bytes, int] = {}
        self.new: list[bytes] = []

    def __missing__(self, run: bytes) -> int:
        mark = MARKS.find(run[-1:]) + 1
        body = run[:-1] if mark else run
        if body.isalnum():
            body = body.lower()
        else:
            text = body.decode(errors="replace")
            low = text.lower()
            if not (text.isalnum() and low.isalnum()):  # marks inside: as it stands
                body, mark = run, 0
            elif "\u03a3" not in text:  # str.lower() has two forms of the final letter
                body = low.encode()
        code = self.bodies.get(body)
        if code is None:
            code = self.bodies[body] = len(self.bodies)
            self.new.append(body)
        value = self[run] = code << 3 | mark
        return value


class WordEncoder:
    """Token ids of whole texts, by remembered runs of characters between ASCII white space."""

    def __init__(self, path: str, memory: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.memory = memory
        self.marks = np.array([0, *(self._ids([chr(m)])[0][0] for m in MARKS)], np.uint32)
        self.between = int(self._ids([SEPARATOR])[0][0])
        self._clear()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bodies(self, bodies: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Sizes and ids of runs: many in one text, with a separator between them that is one token."""
        whole = [b.decode(errors="replace") for b in bodies]
        blocks = [whole[i : i + 200] for i in range(0, len(whole), 200)]
        sizes, flat = [], []
        for block, ids in zip(blocks, self._ids([f" {SEPARATOR} ".join(b) for b in blocks]), strict=True):
            cuts = np.flatnonzero(ids == self.between)
            if len(cuts) == len(block) - 1:
                sizes.append(np.diff(np.r_[-1, cuts, len(ids)]) - 1)
                flat.append(np.delete(ids, cuts))
            else:  # a run holds the separator itself
                own = self._ids(block)
                sizes.append(np.array([len(x) for x in own]))
                flat += own
        return sizes, flat

    def _clear(self) -> None:
        self.runs = Runs()
        self.sizes, self.ends, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.uint32)

    def _learn(self) -> None:
        sizes, flat = self._bodies(self.runs.new)
        self.runs.new = []
        self.sizes = np.concatenate([self.sizes, *sizes])
        self.flat = np.concatenate([self.flat[:-1], *flat, self.flat[:1] * 0])
        self.ends = np.cumsum(self.sizes)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.runs) > self.memory:
            self._clear()
        number = self.runs.__getitem__
        numbers = [np.fromiter(map(number, own), np.int64, len(own)) for own in (t.split() for t in texts)]
        self._learn()
        out = []
        for own in numbers:
            body, mark = own >> 3, own & 7
            sizes = self.sizes[body]
            n = sizes + (mark > 0)
            last = np.cumsum(n)
            ids = self.flat[np.repeat(self.ends[body] - sizes - last + n, n) + np.arange(n.sum())]
            marked = np.flatnonzero(mark)
            ids[last[marked] - 1] = self.marks[mark[marked]]
            out.append(ids)
        return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = 2048,
    end_id: int = 1,
    max_open: int = 512,
    memory: int = 1_000_000,
) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32 bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` names a tokenizer file that every executor has.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = docs.schema[key].dataType.simpleString()
    fields = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    arrow = pa.schema(
        [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
        + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = process_memory("packing")
        if ("encoder", tokenizer, memory) not in remembered:
            remembered["encoder", tokenizer, memory] = WordEncoder(tokenizer, memory)
        encoder, packer = remembered["encoder", tokenizer, memory], SumOfSquares(capacity, max_open)
        sequence = TaskContext.get().partitionId() << 36
        keys: list = []
        columns: list[list] = [[] for _ in arrow.names]
        held, key_arrow = 0, None

        def flush() -> pa.RecordBatch:
            nonlocal keys, columns, held
            arrays = [pa.array(keys, key_arrow), *(pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True))]
            keys, columns, held = [], [[] for _ in arrow.names], 0
            return pa.RecordBatch.from_arrays(arrays, ["key", *arrow.names])

        def store(pieces: list) -> None:
            nonlocal sequence, held
            offset = 0
            for (doc, total), start, ids in pieces:
                keys.append(doc)
                row = (start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += len(ids)
            held += offset
            sequence += 1

        for batch in slices(batches, "text", 2 << 20, "packing"):
            key_arrow = batch.schema.field("key").type
            texts = byte_texts(batch.column("text"))
            for doc, ids in zip(batch.column("key").to_pylist(), encoder.encode(texts), strict=True):
                for pieces in packer.add((doc, len(ids) + 1), np.append(ids, np.uint32(end_id))):
                    store(pieces)
            if held > 2_000_000:
                yield flush()
        if key_arrow is not None:
            for pieces in packer.finish():
                store(pieces)
            yield flush()

    return rows.mapInArrow(run, f"key {key_type}, {fields}").withColumnRenamed("key", key)
