"""Token ids in length-delimited binary files, with a separate index of offsets.

A data file is a row of frames and nothing else:

    length of the content    unsigned 64-bit
    checksum of the length   unsigned 32-bit, masked
    content                  ``length`` bytes
    checksum of the content  unsigned 32-bit, masked

all little-endian.  Checksums are CRC-32, turned right by 15 bits plus a constant, so
that a checksum over data that holds checksums stays useful.  The content is one
document: bytes of an id (2 or 4), length of the key (all ones: no key), the key's
characters, the ids.  Ids take two bytes where the vocabulary allows it.

Documents are dealt out by ranges of their key and sorted; each task writes one file
under a name of its own and returns what it wrote as rows of the index.  Only files
of tasks that ended well are in the index, so a lost executor leaves nothing but a
file that nobody reads.  The index is a Parquet table with a row for each document:
``part, file, record, <key>, offset, length, n_tokens, start``.  Readers go by the index:
in order, neighbours are read at one go; shuffled, each frame is read at its offset.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scrubwell.llm.byte_bpe import BLOCK_CHARS, CUT_BY_CLASS, _blocks, _cut, ragged

MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
CONTENT = struct.Struct("<BI")
NO_KEY = 0xFFFFFFFF
GROUP_CHARS = 6 << 20  # the distinct words of so much text are encoded at once
CACHE_WORDS = 300_000  # words whose ids a task keeps
READ_BYTES = 32 << 20  # of data files for each reading task
SPAN_BYTES = 4 << 20  # read at one go


class CorruptRecord(ValueError):
    """A frame whose lengths or checksums do not agree."""


# --- frames ---------------------------------------------------------------------
def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(content: bytes) -> bytes:
    length = struct.pack("<Q", len(content))
    return b"".join(
        (length, struct.pack("<I", masked(length)), content, struct.pack("<I", masked(content)))
    )


def unframe(data: bytes | memoryview) -> bytes:
    """The content of one frame; an error if anything of it was changed."""
    if len(data) < HEAD.size + 4:
        raise CorruptRecord("the frame is cut short")
    length, check = HEAD.unpack_from(data)
    if masked(bytes(data[:8])) != check or length != len(data) - HEAD.size - 4:
        raise CorruptRecord("the length of a frame is damaged")
    content = bytes(data[HEAD.size : HEAD.size + length])
    if masked(content) != struct.unpack_from("<I", data, HEAD.size + length)[0]:
        raise CorruptRecord("the content of a frame is damaged")
    return content


def serialise(key: str | None, ids: np.ndarray) -> bytes:
    """A document's content; ``ids`` are unsigned, little-endian, of two or four bytes."""
    name = b"" if key is None else key.encode()
    head = CONTENT.pack(ids.dtype.itemsize, NO_KEY if key is None else len(name))
    return b"".join((head, name, ids.tobytes()))


def deserialise(content: bytes) -> tuple[str | None, np.ndarray]:
    width, size = CONTENT.unpack_from(content)
    at = CONTENT.size + (0 if size == NO_KEY else size)
    key = None if size == NO_KEY else content[CONTENT.size : at].decode()
    return key, np.frombuffer(content, f"<u{width}", offset=at).astype("<u4")


# --- encoding --------------------------------------------------------------------
def _characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for the code points
    from 256 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """The ids that a tokenizer file gives for whole texts, without special tokens added.

    A tokenizer that splits at byte-level words and has no other rules gives a text the
    ids of its words; then every distinct word is encoded once.  Other tokenizers,
    and texts that hold one of its added tokens, are encoded as they are.
    """

    def __init__(self, description: str):
        self.tokenizer = Tokenizer.from_str(description)
        splitter = self.tokenizer.pre_tokenizer
        self.by_words = (
            self.tokenizer.normalizer is None
            and self.tokenizer.post_processor is None
            and type(splitter).__name__ == "ByteLevel"
            and not splitter.add_prefix_space
            and splitter.use_regex
            and type(self.tokenizer.model).__name__ == "BPE"
        )
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        self.characters = _characters()
        self.cache: dict[bytes, list[int]] = {}

    def _of_word(self, word: bytes) -> list[int]:
        ids = self.cache.get(word)
        if ids is None:
            text = word.decode("latin-1").translate(self.characters)
            ids = [token.id for token in self.tokenizer.model.tokenize(text)]
            if len(self.cache) < CACHE_WORDS:
                self.cache[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return [self._whole(text) for text in texts]
        special = [any(token in text for token in self.added) for text in texts]
        found: list[np.ndarray] = []
        cuts = [_cut(block, CUT_BY_CLASS) for block in _blocks(texts, BLOCK_CHARS)]
        if not cuts:
            return found
        words = pa.chunked_array([words for words, _ in cuts]).unify_dictionaries().chunks
        known = [self._of_word(word) for word in words[0].dictionary.to_pylist()]
        counts = np.fromiter(map(len, known), np.int64, len(known))
        ids = np.fromiter((i for word in known for i in word), np.uint32, int(counts.sum()))
        starts = np.cumsum(counts) - counts
        for chunk, (_, per_text) in zip(words, cuts):
            of_word = chunk.indices.to_numpy()
            sizes = counts[of_word]
            flat = ids[ragged(starts[of_word], sizes)]
            ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(per_text)]
            found += np.split(flat, ends[:-1])
        return [
            self._whole(text) if whole else own
            for text, whole, own in zip(texts, special, found)
        ]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


# --- writing ----------------------------------------------------------------------
def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write every document's ids and ``end`` to data files in ``folder``; returns the index.

    ``tokenizer`` is the content of a tokenizer file.  Documents lie in ascending order of
    their key over the files in order of ``part``; rows without a key come first, rows that
    share a key are ordered by a hash of their text, so equal rows may stand either way.
    Null texts count as empty and give the end id alone.  ``start`` is the number of ids of all
    documents before.  ``folder`` must be one that all executors share and new: any that
    ``pyarrow.fs`` can write to.  Other columns are ignored; an empty table gives an empty index.

    A key that a third of all rows share, or their missing key, is spread over tasks by
    the hash, and equal texts of it by a drawn number.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)  # one file, whatever the corpus
    # the drawn number follows the rows of a split in order, so a task done again draws the same
    named = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("tie"),
        F.rand(7).alias("spread"),
    )
    order = ["key", "tie", "spread"]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = named.schema["key"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        encoder = Encoder(shared.value)
        small = max(encoder.tokenizer.get_vocab_size(), end + 1) <= 1 << 16
        width = np.dtype("<u2" if small else "<u4")
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(f"{root}/data")
        offset = before = record = 0
        with system.open_output_stream(f"{root}/data/{name}") as out:
            while batch is not None:
                at = 0
                for group in _blocks((t.as_py() or "" for t in batch.column(1)), GROUP_CHARS):
                    keys = batch.column(0).slice(at, len(group))
                    names = [None if k is None else str(k) for k in keys.to_pylist()]
                    lengths, sizes = [], []
                    for label, ids in zip(names, encoder.encode(group)):
                        data = frame(serialise(label, np.append(ids, end).astype(width)))
                        out.write(data)
                        lengths.append(len(data))
                        sizes.append(len(ids) + 1)
                    yield _told(part, name, keys, record, offset, lengths, before, sizes)
                    at += len(group)
                    record += len(group)
                    offset += sum(lengths)
                    before += sum(sizes)
                batch = next(batches, None)

    written = dealt.select("key", "text").mapInArrow(
        write,
        f"part int, file string, record bigint, key {kind}, offset bigint, length bigint, "
        "n_tokens bigint, before bigint",
    )
    # the files are whole only once their tasks have ended, which this write waits for
    written.write.parquet(f"{folder}/written")
    written = spark.read.schema(written.schema).parquet(f"{folder}/written")
    # one row for each file
    sums = written.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    index = written.join(bases, "part").select(
        "part", "file", "record", F.col("key").alias(key), "offset", "length", "n_tokens",
        (F.col("base") + F.col("before")).alias("start"),
    )
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def _told(part, name, keys, record, offset, lengths, before, sizes) -> pa.RecordBatch:
    """Rows of the index for documents that follow one another."""
    many = len(keys)
    lengths, sizes = np.array(lengths, np.int64), np.array(sizes, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(many, part, np.int32)),
            pa.array([name] * many, pa.string()),
            pa.array(record + np.arange(many)),
            keys,
            pa.array(offset + np.cumsum(lengths) - lengths),
            pa.array(lengths),
            pa.array(sizes),
            pa.array(before + np.cumsum(sizes) - sizes),
        ],
        ["part", "file", "record", "key", "offset", "length", "n_tokens", "before"],
    )


# --- reading ----------------------------------------------------------------------
def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def _spans(offsets: list[int], lengths: list[int], files: list[str]) -> Iterator[tuple[int, int]]:
    """Rows ``[first, last)`` whose frames lie side by side, in spans of bounded bytes."""
    first = 0
    for row in range(1, len(offsets) + 1):
        if row < len(offsets):
            joins = files[row] == files[first] and offsets[row] == offsets[row - 1] + lengths[row - 1]
            if joins and offsets[row] + lengths[row] - offsets[first] <= SPAN_BYTES:
                continue
        yield first, row
        first = row


def read_records(
    spark: SparkSession, folder: str, key: str = "doc_id", seed: int | None = None
) -> DataFrame:
    """``<key>, start, n_tokens, ids`` of every document, from the data files.

    ``ids`` is binary: little-endian unsigned 32-bit integers.  Key, number of ids and the ids come
    from the frames, whose checksums are tested (``CorruptRecord``), ``start`` from the index.
    Without a seed rows lie in the order of the files; with one they are shuffled over the
    whole corpus, the same way each time, and each frame is read at its offset.
    """
    index = read_index(spark, folder).select("part", "file", "record", "offset", "length", "start", key)
    kind = index.schema[key].dataType.simpleString()
    total = index.agg(F.sum("length")).first()[0] or 0  # one number
    tasks = -(-total // READ_BYTES) or 1
    if seed is None:
        dealt = index.repartitionByRange(tasks, "part", "offset")
        dealt = dealt.sortWithinPartitions("part", "offset")
    else:
        drawn = F.xxhash64(F.lit(seed), "part", "record")
        dealt = index.withColumn("drawn", drawn).repartitionByRange(tasks, "drawn")
        dealt = dealt.sortWithinPartitions("drawn")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            files, offsets, lengths, starts = (column.to_pylist() for column in batch.columns)
            for first, last in _spans(offsets, lengths, files):
                if files[first] != name:
                    if source:
                        source.close()
                    name = files[first]
                    source = system.open_input_file(f"{root}/data/{name}")
                begin = offsets[first]
                data = memoryview(source.read_at(offsets[last - 1] + lengths[last - 1] - begin, begin))
                rows = [
                    deserialise(unframe(data[offsets[i] - begin :][: lengths[i]]))
                    for i in range(first, last)
                ]
                keys, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.string()),
                        pa.array(starts[first:last], pa.int64()),
                        pa.array([len(own) for own in ids], pa.int64()),
                        pa.array([own.tobytes() for own in ids], pa.binary()),
                    ],
                    ["key", "start", "n_tokens", "ids"],
                )
        if source:
            source.close()

    found = dealt.select("file", "offset", "length", "start").mapInArrow(
        read, "key string, start bigint, n_tokens bigint, ids binary"
    )
    return found.select(F.col("key").cast(kind).alias(key), "start", "n_tokens", "ids")
