"""Token files: ids of documents as independent zstandard frames with a seek table.

A file holds the documents of one range of ids, in ascending order, each as a frame of its
own. Its end is a table of the frames with their sizes and checksums, in the seekable
zstandard format; the ids of the documents stand in a skippable frame before it. So any
zstandard reader reads the whole file, and ``read_documents`` decompresses only the frames
asked for.

Documents are dealt by ranges of (doc_id, hash of the text), which also splits an id that
very many rows share; the number of ranges grows with that of the documents. A task encodes
its range and writes files of ``FILE_BYTES`` or ``FILE_DOCUMENTS`` at most, so the tables that
it holds until a file ends are bounded. One row per file passes on.

Encoding: a byte-level BPE works on pieces of a text between which nothing merges. Words
recur, so pieces are cut off coarsely, before spaces, and their ids are remembered; the
tokenizer sees each distinct word, and each run of marks behind one, once per memory. Where
white space stands before a space, a text is cut by a pattern instead. Texts that hold a
special token go to the tokenizer as a whole, and so do all texts where its own settings are
not those that this holds for. The tokenizer's file must be at the same place on every
executor.

Defined results: a document without text, or with an empty one, has the end id alone.
Documents without an id come first. Repeated rows are encoded each; equal rows have equal
frames. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import (
    TaskFile,
    file_system,
    fresh_folder,
    one_each,
    rows_in_arrow,
    sized_partitions,
    stored,
)

# Fixed values of the seekable format.
SKIPPABLE_IDS = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
TABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
LEVEL = 3

# Pieces remembered per generation; the older of two generations is dropped.
REMEMBERED = 600_000

# A file ends with the document that reaches one of these.
FILE_BYTES = 1 << 30
FILE_DOCUMENTS = 1_000_000

_FILES = pa.schema(
    [
        ("path", pa.string()),
        ("part", pa.int32()),
        ("nth", pa.int32()),
        ("documents", pa.int64()),
        ("ids", pa.int64()),
    ]
)
_FILES_DDL = "path string, part int, nth int, documents long, ids long"
_READ = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "n_tokens", "ids_crc32")]
)
_READ_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"


# -- Encoding -------------------------------------------------------------------------

# Fixed value: white space as the tokenizer's pattern takes it.
_SPACE = "\t-\r \x85\xa0  -     　"
_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
_SPACES = "".join(re.findall(f"[{_SPACE}]", "".join(map(chr, range(0x3001)))))
# Letters, and what ends a piece behind them as one run of marks: no apostrophe, which may
# begin a contraction.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(prints))
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def works_on_pieces(settings: dict) -> bool:
    """Whether a tokenizer is a byte-level BPE whose own pattern cuts off pieces, as they are,
    between which nothing merges."""
    cut, model = settings.get("pre_tokenizer") or {}, settings.get("model") or {}
    return (
        settings.get("normalizer") is None
        and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space")
        and cut.get("use_regex", True)
        and model.get("type", "BPE") == "BPE"
        and not any(
            model.get(name)
            for name in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                "byte_fallback", "ignore_merges",
            )
        )
        and not any(
            token.get(name)
            for token in settings.get("added_tokens") or ()
            for name in ("lstrip", "rstrip", "normalized", "single_word")
            if token.get("special")
        )
    )


class _OpenEnd(Exception):
    """A part of a text ends in white space, which the next part may go on with."""


class _Memory(dict):
    """Ids by part of a text; a part that is not in it is asked for."""

    def __init__(self, ask: Callable[[str], bytes]) -> None:
        super().__init__()
        self.ask = ask

    def __missing__(self, part: str) -> bytes:
        return self.ask(part)


class Encoder:
    """Texts to ids as little-endian 32-bit numbers, the same as the tokenizer gives."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.in_pieces = works_on_pieces(json.loads(self.tokenizer.to_str()))
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added]
        self.letters = byte_letters()
        self.remembered = remembered
        self.new = _Memory(self.part)
        self.old: dict[str, bytes] = {}
        self.blank = lru_cache(10_000)(self.whole)  # runs of white space

    def whole(self, text: str) -> bytes:
        """Ids straight from the tokenizer."""
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of letters with at most a space before them, which are merged as one piece."""
        if word.isascii():  # its letters stand for themselves
            mapped = word.replace(" ", self.letters[32])
        else:
            mapped = word.encode().decode("latin-1").translate(self.letters)
        return _packed([token.id for token in self.tokenizer.model.tokenize(mapped)])

    def part(self, part: str) -> bytes:
        """Ids of a part not met lately: what goes from a space to before the next one."""
        known = self.old.get(part)
        if known is None:
            core = part.rstrip(_MARKS)
            letters = core.removeprefix(" ")
            if letters.isalpha() and (letters.isascii() or _LETTERS.fullmatch(letters)):
                marks = part[len(core) :]
                known = self.new[core] + self.new[marks] if marks else self.word(core)
            elif part[-1] in _SPACES:
                raise _OpenEnd
            elif len(pieces := _PIECES.findall(part)) > 1:  # lines, which hardly recur
                return self._joined(pieces)
            else:
                known = self.whole(part)
        if len(self.new) >= self.remembered:
            self.old = dict(self.new)
            self.new.clear()
        self.new[part] = known
        return known

    def _joined(self, pieces: list[str]) -> bytes:
        """Ids of pieces, where runs of white space are pieces of their own."""
        return b"".join([self.blank(p) if p[-1] in _SPACES else self.new[p] for p in pieces])

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.in_pieces or any(special in text for special in self.special):
            return self.whole(text)
        if "\0" not in text:
            body = text.rstrip(_SPACES)
            parts = body.replace(" ", "\0 ").split("\0")
            if not parts[0]:  # the text begins with a space, or has nothing else
                del parts[0]
            end = text[len(body) :]
            try:
                ids = b"".join(map(self.new.__getitem__, parts))
                return ids + self.blank(end) if end else ids
            except _OpenEnd:
                pass
        return self._joined(_PIECES.findall(text))


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACKERS[n](*ids) if n < len(_PACKERS) else struct.pack(f"<{n}I", *ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The encoder of a worker process, which keeps what it remembers between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, remembered)
    _encoders[path].remembered = remembered
    return _encoders[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# -- File format ----------------------------------------------------------------------


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FrameWriter:
    """Frames to a stream, and the tables behind them."""

    def __init__(self, stream, level: int = LEVEL) -> None:
        self.stream = stream
        self.packer = zstandard.ZstdCompressor(level=level)
        self.frames = array("I")  # compressed size, size, checksum of each
        self.doc_ids: list[int | None] = []
        self.bytes = 0

    def add(self, doc_id: int | None, content: bytes) -> None:
        frame = self.packer.compress(content)
        self.stream.write(frame)
        self.bytes += len(frame)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.frames.extend((len(frame), len(content), checksum))
        self.doc_ids.append(doc_id)

    def finish(self) -> None:
        known = bytes(doc_id is not None for doc_id in self.doc_ids)
        numbers = struct.pack(f"<{len(known)}q", *(doc_id or 0 for doc_id in self.doc_ids))
        ids = self.packer.compress(known + numbers)
        self.stream.write(_skippable(SKIPPABLE_IDS, ids))
        # The table lists the skippable frame too, as one that gives nothing.
        frames = self.frames + array("I", (len(ids) + 8, 0, 0))
        footer = struct.pack("<IBI", len(frames) // 3, WITH_CHECKSUMS, TABLE_MAGIC)
        table = struct.pack(f"<{len(frames)}I", *frames)
        self.stream.write(_skippable(SKIPPABLE_TABLE, table + footer))


class FrameReader:
    """Random access to the documents of a file."""

    def __init__(self, file, size: int) -> None:
        self.file = file
        self.unpacker = zstandard.ZstdDecompressor()
        footer = self._at(size - 9, 9)
        n, flags, magic = struct.unpack("<IBI", footer)
        if magic != TABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = array("I", self._at(size - 9 - 12 * n, 12 * n))
        self.packed, self.sizes, self.checksums = table[0::3], table[1::3], table[2::3]
        self.offsets = [0]
        for length in self.packed:
            self.offsets.append(self.offsets[-1] + length)
        index = self._at(self.offsets[n - 1] + 8, self.packed[n - 1] - 8)
        index = self.unpacker.decompress(index)
        known, numbers = index[: n - 1], struct.unpack(f"<{n - 1}q", index[n - 1 :])
        self.doc_ids = [i if ok else None for ok, i in zip(known, numbers, strict=True)]

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def content(self, place: int) -> bytes:
        """The ids of one document, verified; no other frame is read."""
        frame = self._at(self.offsets[place], self.packed[place])
        size = self.sizes[place]
        content = self.unpacker.decompress(frame, max_output_size=size)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        if len(content) != size or checksum != self.checksums[place]:
            raise ValueError(f"wrong checksum in frame {place}")
        return content


def open_frames(path: str) -> FrameReader:
    system, name = file_system(path)
    file = system.open_input_file(name)
    return FrameReader(file, file.size())


def read_documents(path: str, doc_ids: Iterable[int | None]) -> Iterator[tuple[int | None, array]]:
    """The ids of chosen documents of one file."""
    wanted, frames = set(doc_ids), open_frames(path)
    for place, doc_id in enumerate(frames.doc_ids):
        if doc_id in wanted:
            yield doc_id, array("I", frames.content(place))


# -- On Spark -------------------------------------------------------------------------


def write_token_files(
    documents: DataFrame,
    tokenizer: str | None = None,
    folder: str | None = None,
    file_bytes: int = FILE_BYTES,
    file_documents: int = FILE_DOCUMENTS,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode and write all documents. Returns the files in the order of their documents:
    path, part, nth, documents, ids, and ``before``, the number of ids in the files before.

    ``remembered`` pieces, twice, are what a worker holds of texts it has encoded.
    """
    tokenizer = tokenizer or tokenizer_path()
    folder = folder or fresh_folder(documents.sparkSession, "tokens")
    end = _packed([END_ID])

    def write(rows: Iterator[dict]) -> Iterator[tuple]:
        encode = encoder(tokenizer, remembered)
        file = frames = None
        n = nth = 0

        def finished() -> tuple:
            frames.finish()
            return file.commit(), file.part, file.nth, len(frames.doc_ids), n

        for row in rows:
            if file is None:
                file, n = TaskFile(folder, ".ids.zst", nth), 0
                frames = FrameWriter(file.stream)
            ids = encode(row["text"]) + end
            frames.add(row["doc_id"], ids)
            n += len(ids) // 4
            if frames.bytes >= file_bytes or len(frames.doc_ids) >= file_documents:
                yield finished()
                file, nth = None, nth + 1
        if file:
            yield finished()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    ranged = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "text",
            F.xxhash64("text").alias("tie"),
        )
        .repartitionByRange(sized_partitions(documents), *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    files = stored(ranged.mapInArrow(rows_in_arrow(write, _FILES), _FILES_DDL), "token-files")
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Where each document stands: doc_id, start, n_tokens, ids_crc32."""

    def read(rows: Iterator[dict]) -> Iterator[tuple]:
        for row in rows:
            frames, start = open_frames(row["path"]), row["before"]
            for place, doc_id in enumerate(frames.doc_ids):
                content = frames.content(place)
                yield doc_id, start, len(content) // 4, zlib.crc32(content)
                start += len(content) // 4

    spread = one_each(files.select("path", "before"), files.count())
    return spread.mapInArrow(rows_in_arrow(read, _READ), _READ_DDL)
