"""Token-ID output: Arrow stream files of fixed-size-list batches.

The documents are range partitioned and sorted by id; each partition encodes
its texts, appends the end id and packs the ids into sequences of ``length``
ids without gaps.  One file per partition holds the Arrow stream: batches of
``rows`` sequences (the last one shorter) with

* ``input_ids``: ``fixed_size_list<uint16|uint32>[length]``,
* ``attention_mask``: ``fixed_size_list<bool>[length]``, false on the padding of a file's last sequence,
* ``doc_ends``: where in the sequence documents end, and ``doc_ids``: which ones.

All batches but the last have the same number of rows and the same layout, so
:class:`SequenceFile` maps a file, reads the batch headers only and hands out
any sequence and mask as views of the mapped pages.

The driver sees one manifest row per file.  A file appears under its name only
when complete and its name is its partition, so retries replace like with like.

Defined results: a null text counts as empty (one id, the end); a null id sorts
first; rows repeated with one id are ordered by text; an empty table writes no
file and gives an empty result; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import RecentCache, scratch_path, slices, written
from tessera.llm.files import AtomicFile, open_random

LENGTH = 2048
ROWS = 64

#: White space of the tokenizer's splitting pattern (Unicode White_Space), fixed value.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
#: Letters of which a run, if ASCII other than a letter or the end follows, is one whole pre-token.
_LETTERS = "A-Za-z" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0xFF)))
# Units: such a run with an optional space; else an optional space and a run without white space;
# a run of white space up to its last character; or that one.
_WORD = f" ?[{_LETTERS}]+(?=[\\x00-@\\[-`{{-\\x7f]|\\Z)"
_UNIT = re.compile(f"{_WORD}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
_IS_WORD = re.compile(f" ?[{_LETTERS}]+")
_UNITS_AT_A_TIME = 1 << 18


def _byte_characters() -> dict[int, str]:
    """The byte-level vocabulary's character per byte: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class UnitEncoder:
    """Encodes whole texts with the ``tokenizers`` library, each distinct unit of text once.

    The byte-level splitting pattern always has a border between two units,
    and what lies between two borders encodes alike wherever it stands: at a
    space followed by a non-space, and at the end of a run of letters.  Runs of
    letters are whole pre-tokens and go to the library's BPE model directly,
    other units through the whole tokenizer.  The ids of frequent units are
    kept while the process lives.
    """

    CACHED = 200_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.characters = _byte_characters()
        self.known = RecentCache(self._encode_unit, self.CACHED)

    def _encode_unit(self, unit: str) -> bytes:
        if _IS_WORD.fullmatch(unit):
            piece = unit.encode("utf-8").decode("latin-1").translate(self.characters)
            ids = [t.id for t in self.model.tokenize(piece)]
        else:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian integers of ``dtype``."""
        if len(text) < 1 << 20:
            return b"".join(map(self.known.__getitem__, _UNIT.findall(text)))
        units = (m.group() for m in _UNIT.finditer(text))
        parts = iter(lambda: list(itertools.islice(units, _UNITS_AT_A_TIME)), [])
        return b"".join(b"".join(map(self.known.__getitem__, part)) for part in parts)


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """The process's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def schema(ids: pa.DataType, length: int, doc: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("input_ids", pa.list_(pa.field("item", ids, nullable=False), length)),
        ("attention_mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length)),
        ("doc_ends", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(doc)),
    ])


class SequenceWriter:
    """Packs ids into sequences and writes them in batches of ``rows``."""

    def __init__(self, sink, dtype: np.dtype, length: int, rows: int, doc: pa.DataType):
        self.dtype, self.length, self.rows = dtype, length, rows
        self.schema = schema(pa.from_numpy_dtype(dtype), length, doc)
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[bytes] = []
        self.held = 0  # ids not yet written
        self.ends: list[tuple[int, object]] = []  # place among the held ids, document
        self.sequences = self.tokens = self.documents = 0

    def add(self, doc, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.parts.append(ids)
        self.held += n
        self.tokens += n
        self.documents += 1
        self.ends.append((self.held - 1, doc))
        if self.held >= 8 * self.rows * self.length:
            self._flush(self.held // (self.rows * self.length) * self.rows)

    def _flush(self, sequences: int) -> None:
        """Write the first ``sequences`` sequences of the held ids, the last one padded if need be."""
        ids = np.frombuffer(b"".join(self.parts), self.dtype)
        valid = min(len(ids), sequences * self.length)
        for k in range(0, sequences, self.rows):
            n = min(self.rows, sequences - k)
            a, b = k * self.length, (k + n) * self.length
            block = ids[a : min(b, valid)]
            mask = np.ones(b - a, bool)
            if len(block) < b - a:
                mask[len(block) :] = False
                block = np.concatenate((block, np.zeros(b - a - len(block), self.dtype)))
            cut = next((i for i, e in enumerate(self.ends) if e[0] >= b), len(self.ends))
            here, self.ends = self.ends[:cut], self.ends[cut:]
            row = np.array([(e - a) // self.length for e, _ in here], np.int64)
            offsets = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
            places = pa.array(np.array([(e - a) % self.length for e, _ in here], np.int32))
            docs = pa.array([d for _, d in here], self.schema.field("doc_ids").type.value_type)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(block), type=self.schema.field(0).type),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field(1).type),
                pa.ListArray.from_arrays(offsets, places),
                pa.ListArray.from_arrays(offsets, docs),
            ]
            self.stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.sequences += n
        rest = ids[valid:]
        self.parts, self.held = [rest.tobytes()], len(rest)
        self.ends = [(e - valid, d) for e, d in self.ends]

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length))
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one file; arrays are views of the mapped file."""

    def __init__(self, uri: str):
        self.source = open_random(uri)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.per_batch = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """``(ids, mask)`` of sequence ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = self.batches[i // self.per_batch], i % self.per_batch
        ids, mask = batch.column(0), batch.column(1)
        length = ids.type.list_size
        return ids.values.slice((ids.offset + row) * length, length).to_numpy(zero_copy_only=True), mask.values.slice((mask.offset + row) * length, length)


def write(
    docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 0, length: int = LENGTH, rows: int = ROWS,
) -> DataFrame:
    """Write the token files of ``docs`` to ``folder``; returns the manifest ``part, file, documents, tokens, sequences``."""
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(parts, "_id").sortWithinPartitions("_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        own = encoder(vocabulary)
        end = np.array([end_id], own.dtype).tobytes()
        part = TaskContext.get().partitionId()
        target = AtomicFile(folder, f"part-{part:06d}.arrows")
        with target as sink:
            writer = SequenceWriter(sink, own.dtype, length, rows, first.schema.field(0).type)
            for rows_ in slices(itertools.chain([first], batches)):
                for doc, text in zip(*(c.to_pylist() for c in rows_.columns), strict=True):
                    writer.add(doc, own.encode(text or "") + end)
            writer.close()
        counts = [[part], [target.uri], [writer.documents], [writer.tokens], [writer.sequences]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in counts], names=["part", "file", "documents", "tokens", "sequences"]
        )

    return written(dealt.mapInArrow(run, "part long, file string, documents long, tokens long, sequences long"), "manifest")


def read_documents(spark: SparkSession, manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32`` and where it starts (``file, sequence, offset``).

    The manifest's running token counts (one row per file) give every file its start.
    """
    files, start = [], 0
    for r in sorted(manifest.collect()):
        files.append((r.part, r.file, start))
        start += r.tokens
    if not files:
        return spark.createDataFrame([], f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, file string, sequence long, offset int")
    dealt = spark.createDataFrame(files, "part long, file string, start long").repartitionByRange(len(files), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from _documents_of(file, start)

    return dealt.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, file string, sequence long, offset int")


def _documents_of(file: str, start: int) -> Iterator[pa.RecordBatch]:
    carried: list[bytes] = []  # ids of the document that is open, as little-endian unsigned 32-bit integers
    done = 0  # ids of the file before this batch
    began = 0  # ids of the file before the open document
    for batch in pa.ipc.open_stream(open_random(file)):
        ids, mask, ends, docs = batch.columns
        length = ids.type.list_size
        wide = ids.values.to_numpy(zero_copy_only=True).astype("<u4")
        row = np.repeat(np.arange(batch.num_rows), np.diff(ends.offsets.to_numpy()))
        places = row * length + ends.flatten().to_numpy()
        rows, at = [], 0
        for place in places.tolist():
            carried.append(wide[at : place + 1].tobytes())
            data = b"".join(carried)
            rows.append((start + began, len(data) // 4, zlib.crc32(data), began // length, began % length))
            began = done + place + 1
            at, carried = place + 1, []
        valid = len(wide) if mask.values.true_count == len(wide) else int(mask.values.true_count)
        carried.append(wide[at:valid].tobytes())
        done += len(wide)
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [docs.flatten(), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array([file] * len(rows), pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32())],
            names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "sequence", "offset"],
        )


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
               length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Write the token files to the shared scratch folder and read the documents back from them."""
    spark = docs.sparkSession
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    manifest = write(docs, f"{scratch_path(spark, 'tokens')}/files", vocabulary, id_col, text_col, 0, length, rows)
    return read_documents(spark, manifest, kind).withColumnRenamed("doc_id", id_col)
