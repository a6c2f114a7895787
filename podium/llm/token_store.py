"""Token ids in Huffman-coded files.

Rows are range-partitioned by id, encoded with the given tokenizer and staged;
the counts of all ids give one canonical length-limited Huffman code
(:mod:`podium.llm.huffman`), and every task writes its run of documents as a
file.  Files stand alone:

    "CTF1", uint32 size of the zlib-packed code lengths, code lengths
    per block: bits of BLOCK ids, then its checkpoints (uint32 bit offsets)
    directory (zlib): blocks (first id, ids, byte offset, bytes, checkpoints),
                      documents (doc_id, has_id, start, n_tokens)
    uint64 offset of the directory, uint64 number of ids, "CTF1"

A file's name carries the position of its first id, so the names' order is the
order of ids.  Tasks write under names of their own attempt and report them;
only reported files are read, so a lost executor or a repeated task leaves
nothing but an unread file.  Files go through pyarrow's file systems.

Defined results: null text is the empty text (only the end id); null ids come
first; rows that repeat an id are written one after the other; an empty table
writes no file and reads back no row.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import huffman
from podium.llm import textkernel as tk
from podium.llm.common import in_order_by, mapped, part_offsets, scratch_path, staged, table, task_uri, unstage

MAGIC = b"CTF1"
#: ids per block
BLOCK = 1 << 17
END_ID = 2
#: pieces a worker remembers, and bytes of text it looks up at once
CACHE, SLICE = 1 << 21, 1 << 21

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: bytes after a space that do not begin white space: printable ASCII, and leads other than C2, E1, E2, E3
_AFTER_SPACE = np.zeros(256, bool)
_AFTER_SPACE[33:127] = _AFTER_SPACE[0xC3:0xE1] = _AFTER_SPACE[0xE4:0xF5] = True


def piece_starts(data: np.ndarray, row_at: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces begin that the byte-level pre-tokenizer never joins.

    Its pattern takes a space only as the first character of a word, number or
    symbol run, and never crosses from a letter to punctuation; it looks behind
    nothing, and ahead only past white space.  So a piece may begin at every
    space that no white space follows, and at punctuation after a letter or
    digit (ASCII, or Latin-1 without the two signs among them).
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    opens = np.zeros(n, bool)
    opens[:-1] = (data[:-1] == 32) & _AFTER_SPACE[data[1:]]
    before = _ALNUM[data[:-1]]
    latin = (data[1:-1] >= 0x80) & (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    before[1:] |= latin
    opens[1:] |= before & _PUNCT[data[1:]]
    opens[row_at[:-1][np.diff(row_at) > 0]] = True
    return np.flatnonzero(opens)


class Table:
    """Hash of a piece -> its ids: open addressing in numpy arrays, emptied when half full."""

    def __init__(self, entries: int = CACHE):
        self.size = 2 * entries
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(self.size, np.uint64)  # 0: free
        self.at = np.zeros(self.size, np.int32)
        self.used = self.n_ids = 0
        self.first = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.uint32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        slot = (h % np.uint64(self.size)).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        while len(todo):
            key = self.key[slot[todo]]
            hit = key == h[todo]
            out[todo[hit]] = self.at[slot[todo[hit]]]
            todo = todo[~hit & (key != 0)]
            slot[todo] = (slot[todo] + 1) % self.size
        return out

    def add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        """New distinct hashes with their ids."""
        count = np.array([len(x) for x in ids], np.int32)
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))
        self.first = _room(self.first, self.used, len(h))
        self.count = _room(self.count, self.used, len(h))
        self.ids = _room(self.ids, self.n_ids, len(flat))
        entry = np.arange(self.used, self.used + len(h))
        self.count[entry] = count
        self.first[entry] = self.n_ids + np.cumsum(count) - count
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.used, self.n_ids = self.used + len(h), self.n_ids + len(flat)
        slot = (h % np.uint64(self.size)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            free = todo[self.key[slot[todo]] == 0]
            self.key[slot[free]] = h[free]  # of several for one slot the last stays
            won = free[self.key[slot[free]] == h[free]]
            self.at[slot[won]] = entry[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) % self.size


def _room(a: np.ndarray, used: int, more: int) -> np.ndarray:
    return a if used + more <= len(a) else np.concatenate((a[:used], np.zeros(max(more, used) + more, a.dtype)))


class Tokenizer:
    """A tokenizers file; for byte-level ones the ids of pieces are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Loaded

        self.model = Loaded.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pre = told.get("pre_tokenizer") or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.in_pieces = told.get("normalizer") is None and all(pre.get(k) == v for k, v in plain.items())
        self.special = [x["content"].encode() for x in told.get("added_tokens") or []]
        self.table = Table()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every row; null is the empty text."""
        for _, _, data, row_at in tk.slices(column, SLICE):
            raw = data.tobytes()
            # a special token's string may lie across pieces: such texts are encoded whole
            whole = not self.in_pieces or any(x in raw for x in self.special)
            if whole:
                yield from (np.array(x, np.uint32) for x in self.whole([raw[a:z].decode() for a, z in zip(row_at[:-1], row_at[1:])]))
            else:
                yield from self._by_pieces(data, raw, row_at)

    def _by_pieces(self, data: np.ndarray, raw: bytes, row_at: np.ndarray) -> list[np.ndarray]:
        start = piece_starts(data, row_at)
        if not len(start):
            return [np.empty(0, np.uint32)] * (len(row_at) - 1)
        end = np.append(start[1:], len(data))
        h = tk.hash_words(data, start, end, None) | np.uint64(1)
        kinds, shown, of = np.unique(h, return_index=True, return_inverse=True)
        if not ((end - start) == (end - start)[shown][of]).all():  # two pieces of one hash: never mind the pieces
            return [np.array(x, np.uint32) for x in self.whole([raw[a:z].decode() for a, z in zip(row_at[:-1], row_at[1:])])]
        if self.table.used + len(kinds) > CACHE:
            self.table.clear()
        entry = self.table.find(kinds)
        new = np.flatnonzero(entry < 0)
        for lo in range(0, len(new), 4096):
            part = new[lo : lo + 4096]
            at = shown[part]
            self.table.add(kinds[part], self.whole([raw[a:z].decode() for a, z in zip(start[at], end[at])]))
            entry[part] = np.arange(self.table.used - len(part), self.table.used)
        piece = entry[of]
        count = self.table.count[piece].astype(np.int64)
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.table.ids[np.arange(total[-1]) + np.repeat(self.table.first[piece] - total[:-1], count)]
        return np.split(ids, total[np.searchsorted(start, row_at[1:-1])])


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n and ids (little-endian uint32) of every row, in id order with ``_part`` and ``_start``.

    ``_start`` counts the ids before the row inside its range partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, start = TaskContext.get().partitionId(), 0
        model = tokenizer(path)
        for b in batches:
            every = model.encode(b.column(1))
            for lo in range(0, len(b), 512):
                c = b.slice(lo, 512)
                ids = [np.append(x, np.uint32(end_id)) for x in islice(every, len(c))]
                n = np.array([len(x) for x in ids], np.int64)
                at = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), pa.array(n), pa.array([narrow(x) for x in ids], pa.binary()), pa.array(np.full(len(c), part, np.int64)), pa.array(at)],
                    ["doc_id", "n", "ids", "_part", "_start"],
                )

    ranged = in_order_by(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), [F.col("doc_id"), F.xxhash64("text")])
    return staged(mapped(ranged, run, "doc_id long, n long, ids binary, _part long, _start long"), "tokens")


def narrow(ids: np.ndarray) -> bytes:
    """Two bytes per id if all fit, else four; the first byte says which."""
    return b"\2" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype(np.uint32)


def count_ids(tokens: DataFrame) -> np.ndarray:
    """Global count per id (one row per id of the vocabulary reaches the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for lo in range(0, len(b), 1024):
                got = np.bincount(np.concatenate([widen(raw) for raw in b.column(0).slice(lo, 1024).to_pylist()]))
                if len(got) > len(total):
                    got[: len(total)] += total
                    total = got
                else:
                    total[: len(got)] += got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    got = mapped(tokens.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(int(got["id"].to_numpy().max(initial=-1)) + 1, np.int64)
    out[got["id"].to_numpy()] = got["n"].to_numpy()
    return out


class Writer:
    """One file: ids are added in order, whole blocks go out as they fill."""

    def __init__(self, fs: pafs.FileSystem, path: str, code: huffman.Code, start: int):
        self.path, self.code, self.at_id = path, code, start
        self.sink = fs.open_output_stream(path)
        packed = zlib.compress(code.lengths.tobytes())
        self.offset = self.sink.write(MAGIC + struct.pack("<I", len(packed)) + packed)
        self.blocks: list[tuple[int, ...]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.total = 0

    def add(self, doc_id: int | None, start: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, int(doc_id is not None), start, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= BLOCK:
            self._block(BLOCK)

    def _block(self, n: int) -> None:
        ids = np.concatenate(self.held)
        self.held, self.n_held = [ids[n:]], len(ids) - n
        bits, marks = self.code.encode(ids[:n])
        self.blocks.append((self.at_id, n, self.offset, len(bits), len(marks)))
        self.offset += self.sink.write(bits + marks.tobytes())
        self.at_id += n
        self.total += n

    def close(self) -> None:
        if self.n_held:
            self._block(self.n_held)
        blocks, docs = (np.array(x, np.int64).reshape(-1, k) for x, k in ((self.blocks, 5), (self.docs, 4)))
        self.sink.write(zlib.compress(struct.pack("<QQ", len(blocks), len(docs)) + blocks.tobytes() + docs.tobytes()))
        self.sink.write(struct.pack("<QQ", self.offset, self.total) + MAGIC)
        self.sink.close()


#: documents or ids after which a file is closed and the next begun (its directory is held in memory)
FILE_DOCS, FILE_IDS = 1 << 18, 1 << 26


def write(tokens: DataFrame, folder: str) -> DataFrame:
    """Writes the staged tokens under ``folder`` and returns the table of its files (path, start, n_tokens, n_docs)."""
    sums = {r["_part"]: r["n"] for r in tokens.groupBy("_part").agg(F.sum("n").alias("n")).collect()}
    before = part_offsets(sums)
    lengths = zlib.compress(huffman.code_lengths(count_ids(tokens)).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        code, now, due = None, None, None
        done: list[tuple[str, int, int, int]] = []

        def close():
            now.close()
            done.append((f"{folder}/{now.path.rsplit('/', 1)[1]}", now.docs[0][2], now.total, len(now.docs)))

        for b in batches:
            for doc_id, raw, part, at in zip(*(b.column(i).to_pylist() for i in range(4))):
                ids, start = widen(raw), before[part] + at
                # a task's rows are runs of consecutive documents; a gap begins a new file
                if now is not None and (start != due or len(now.docs) >= FILE_DOCS or now.total >= FILE_IDS):
                    close()
                    now = None
                if now is None:
                    code = code or huffman.Code(np.frombuffer(zlib.decompress(lengths), np.uint8))
                    now = Writer(fs, f"{base}/ids-{start:020d}-{uuid.uuid4().hex}.ctf", code, start)
                now.add(doc_id, start, ids)
                due = start + len(ids)
        if now is not None:
            close()
        cols = list(zip(*done)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["path", "start", "n_tokens", "n_docs"]
        )

    return staged(mapped(tokens.select("doc_id", "ids", "_part", "_start"), run, "path string, start long, n_tokens long, n_docs long"), "files")


class Reader:
    """Random access to one file by its directory."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 20)
        at, self.total, magic = struct.unpack("<QQ4s", self.file.read(20))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.file.seek(at)
        raw = zlib.decompress(self.file.read(size - 20 - at))
        n_blocks, n_docs = struct.unpack_from("<QQ", raw)
        self.blocks = np.frombuffer(raw, np.int64, n_blocks * 5, 16).reshape(-1, 5)
        self.docs = np.frombuffer(raw, np.int64, n_docs * 4, 16 + 40 * n_blocks).reshape(-1, 4)
        self.file.seek(4)
        (packed,) = struct.unpack("<I", self.file.read(4))
        self.code = huffman.Code(np.frombuffer(zlib.decompress(self.file.read(packed)), np.uint8))

    def block(self, i: int) -> np.ndarray:
        _, n, offset, size, marks = (int(x) for x in self.blocks[i])
        self.file.seek(offset)
        raw = self.file.read(size + 4 * marks)
        return self.code.decode(raw[:size], np.frombuffer(raw, np.uint32, marks, size), n)

    def pieces(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(index of the document, some of its ids, whether they are its last), one block in memory at a time."""
        i, left = 0, None
        for b in range(len(self.blocks)):
            ids, at = self.block(b), 0
            while at < len(ids) or (i < len(self.docs) and left == 0):
                left = int(self.docs[i, 3]) if left is None else left
                part = ids[at : at + left]
                at += len(part)
                left -= len(part)
                yield i, part, left == 0
                if left == 0:
                    i, left = i + 1, None

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids at global positions [start, stop), decoding only the blocks that hold them."""
        first = max(0, int(np.searchsorted(self.blocks[:, 0], start, "right")) - 1)
        out = []
        for b in range(first, len(self.blocks)):
            at, n = int(self.blocks[b, 0]), int(self.blocks[b, 1])
            if at >= stop:
                break
            out.append(self.block(b)[max(0, start - at) : stop - at])
        return np.concatenate(out) if out else np.empty(0, np.uint32)


def read_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                r = Reader(uri)
                crc = np.zeros(len(r.docs), np.int64)
                count = np.zeros(len(r.docs), np.int64)
                for i, ids, _ in r.pieces():
                    crc[i] = zlib.crc32(ids.astype("<u4").tobytes(), int(crc[i]))
                    count[i] += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.docs[:, 0], mask=r.docs[:, 1] == 0), pa.array(r.docs[:, 2]), pa.array(count), pa.array(crc)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # a row is a whole file: a number given by the files is not merged by the few bytes of their names
    dealt = files.select("path").repartition(max(2, files.count()))
    return mapped(dealt, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Tokenizes and writes ``docs`` below the shared folder; returns the table of files."""
    spark = docs.sparkSession
    tokens = tokenize(docs, path, end_id)
    folder = scratch_path(spark, "ids")
    files = write(tokens, task_uri(spark, folder))
    unstage(tokens)
    return files


def public_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_digests(store(table(spark, sf_dir, "documents"), public_vocabulary()))
