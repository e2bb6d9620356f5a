"""Packing of tokenised documents into fixed windows, online and in bounded space.

Each partition keeps a fixed number of open windows. A document goes whole into the window it fills best; one
longer than a window is cut into full windows first. When none has room, the head of the document fills the
fullest window, that window is emitted, and the rest is placed anew. What is open at the end of a partition
goes to a merge that takes the leftovers of a fixed number of partitions and fills windows one after another.

Only the tokens of the open windows are held. A document's tokens lie in consecutive pieces, each token in
one. The pieces of a partition are committed together, so a lost executor cannot mix two attempts.

Cases: a null or empty text is one token, the end id; null ids and repeated rows are packed like any other;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from clientlens.llm.common import Memo, kept, slices, staged

# What the vocabulary's own pre-tokenizer keeps, for lower-cased text of the Latin letters below (fixed value).
LATIN = "a-zß-öø-ÿ"
LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^\s0-9{LATIN}]+")
# Printable ASCII and composed Latin letters: lower case and composition cannot depend on what is around them.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Control characters that str.split() takes for white space and the tokenizer does not.
OTHER_SPACE = re.compile("[\x1c-\x1f]")
MERGED = 1 << 62


def byte_signs() -> list[str]:
    """The character that byte-level vocabularies write for each byte: its own if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b if b in printable else 256 + others.index(b)) for b in range(256)]


# Texts that tell whether a vocabulary takes words apart as LATIN_PIECES does, and text at white space.
PROBES = ("plain", "We'll", "x1y22", "ÀÉßø", "a.b,c!", "--=", "(it's)", "don't2", "naïve", "UPPER")
SPACED = ("ab cd", "ab  cd\n\tef", " ab.", "ab \u00a0 cd ")


def encoder(path: str, most: int = 600_000) -> Callable[[str], np.ndarray]:
    """Text -> ids of the tokenizer file at `path`, as it gives them itself without special tokens added.

    Where the vocabulary drops white space, a text's ids are those of its words in a row, and words are encoded once and
    remembered; where it takes words apart in the common way, plain ones go to its merges at once. Both are
    tried out on fixed texts; a vocabulary of another make encodes every text as a whole.
    """
    own = Tokenizer.from_file(path)
    merges, shown = own.model, byte_signs()
    code = "H" if own.get_vocab_size() <= 1 << 16 else "I"
    pack = lambda ids: array(code, ids).tobytes()
    signs = lambda word: word if word.isascii() else "".join([shown[b] for b in word.encode()])
    words = Memo(lambda word: pack([t.id for t in merges.tokenize(signs(word))]), most)
    whole = lambda text: pack(own.encode(text, add_special_tokens=False).ids)
    plain = lambda text: b"".join([words[w] for w in LATIN_PIECES.findall(text.lower())])
    direct = all(plain(p) == whole(p) for p in PROBES)
    apart = all(b"".join(map(whole, t.split())) == whole(t) for t in SPACED)

    def chunk(text: str) -> bytes:
        # Plain words go to the merges at once; the tokenizer's own way is several times slower.
        if direct and PLAIN.fullmatch(text) and "<|" not in text:
            return plain(text)
        return whole(text)

    chunks = Memo(chunk, most)

    def ids(text: str) -> np.ndarray:
        if not apart or OTHER_SPACE.search(text):
            packed = whole(text)
        else:
            packed = b"".join(map(chunks.__getitem__, text.split()))
        return np.frombuffer(packed, dtype=code).astype(np.uint32)

    return ids


class Windows:
    """Open windows of one partition. `emit(pieces)` gets the pieces (document, start, ids) of each closed one."""

    def __init__(self, capacity: int, most: int, least: int, emit: Callable) -> None:
        self.capacity, self.most, self.least, self.emit = capacity, most, least, emit
        self.open: list[list] = []  # [free, pieces]

    def put(self, doc: object, start: int, ids: np.ndarray) -> None:
        while len(ids) >= self.capacity:
            self.emit([(doc, start, ids[: self.capacity])])
            start, ids = start + self.capacity, ids[self.capacity :]
        while len(ids):
            room = [w for w in self.open if w[0] >= len(ids)]
            if room:
                window = min(room, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(window := [self.capacity, []])
            else:
                window = min(self.open, key=lambda w: w[0])
                if window[0] < self.least:
                    self.close(window)
                    continue
            head = ids[: window[0]]
            window[1].append((doc, start, head))
            window[0] -= len(head)
            start, ids = start + len(head), ids[len(head) :]
            if not window[0]:
                self.close(window)

    def close(self, window: list) -> None:
        self.open = [w for w in self.open if w is not window]
        self.emit(window[1])


def pack_documents(
    docs: DataFrame,
    *,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    open_windows: int = 32,
    least_piece: int = 16,
    merge_partitions: int = 64,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    `least_piece` is the shortest head cut off to fill a window (a smaller gap stays padding).
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("id", kind)]
        + [T.StructField(c, T.LongType()) for c in "start length ids_crc32 doc_tokens sequence_id offset".split()]
        + [T.StructField("ids", T.BinaryType()), T.StructField("part", T.LongType())]
    )

    # Leftovers travel to the merge in as few bytes as the vocabulary allows.
    known = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    width = "<u2" if known <= 1 << 16 else "<u4"

    def rows_of(pieces: list, sequence: int) -> Iterator[tuple]:
        offset = 0
        for (key, tokens), start, ids in pieces:
            yield key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens, sequence, offset, None, None
            offset += len(ids)

    def batch_of(rows: list, key_type: pa.DataType) -> pa.RecordBatch:
        types = [key_type] + [pa.int64()] * 6 + [pa.binary(), pa.int64()]
        columns = list(zip(*rows)) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, types)], names=[f.name for f in schema.fields]
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = kept(("tokenizer", tokenizer_path), lambda: encoder(tokenizer_path))
        rows, made, key_type = [], 0, None

        def emit(pieces: list) -> None:
            nonlocal made
            rows.extend(rows_of(pieces, (part << 32) + made))
            made += 1

        windows = Windows(capacity, open_windows, least_piece, emit)
        end = np.array([end_id], dtype=np.uint32)
        for batch in slices(batches, "text"):
            key_type = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.concatenate([encode(text or ""), end])
                windows.put((key, len(ids)), 0, ids)
            yield batch_of(rows, key_type)
            rows.clear()
        for _, pieces in windows.open:
            for (key, tokens), start, ids in pieces:
                rows.append((key, start, len(ids), None, tokens, None, None, ids.astype(width).tobytes(), part))
        if rows:
            yield batch_of(rows, key_type)

    def merge(table: pa.Table) -> pa.Table:
        rows: list = []
        group = table.column("group")[0].as_py()
        windows = Windows(capacity, 1, 1, lambda p: rows.extend(rows_of(p, MERGED + (group << 32) + len(rows))))
        columns = (table.column(c).to_pylist() for c in ("id", "doc_tokens", "start", "ids"))
        for key, tokens, start, ids in zip(*columns):
            windows.put((key, tokens), start, np.frombuffer(ids, dtype=width).astype(np.uint32))
        for window in list(windows.open):
            windows.close(window)
        return pa.Table.from_batches([batch_of(rows, table.schema.field("id").type)])

    pieces = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(pack, schema), "packed"
    )
    left = pieces.where("part is not null").withColumn("group", F.expr(f"part div {merge_partitions}"))
    merged = left.groupBy("group").applyInArrow(merge, schema)
    columns = [F.col("id").alias(id_col), *schema.names[1:7]]
    return pieces.where("part is null").select(*columns).unionByName(merged.select(*columns))
