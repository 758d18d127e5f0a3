"""Token ids of documents in shards, each a compressed file around a wavelet matrix.

Documents are ordered by id (null first, then as the type orders; equal ids by a hash of the
text), encoded, ended by one id, and cut into shards at document ends. A shard file is

    WMT1 | header length u32 | header (JSON) | sections

with the sections (Zstandard frames) ids, null flags and lengths of the documents, then for
every bit-plane its words and its rank directory. Readers load the planes they need.

Files are written aside and renamed, under names that follow from partition and number: a task
that runs again replaces its files by equal ones, and only files of the manifest are read.
Defined results: a null or empty text has the end id alone; repeated rows are written each; no
rows give no files and no result rows.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import put_file, stored
from orderloom.llm.wavelet import Plane, WaveletMatrix

MAGIC = b"WMT1"
# Texts are encoded in blocks of about so many bytes.
BLOCK_BYTES = 16_000_000
SHARD_TOKENS = 1_000_000
# The most words in a worker's table, and pieces to make up others from.
WORDS_KEPT = 600_000
PIECES_KEPT = 100_000

# Below this letter the two pattern libraries agree on what letters and numbers are.
_CERTAIN = "\u0500"
# The byte-level tokenizer's cutting pattern, and its signs for bytes.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_SIGNS = {**{b: b for b in _SHOWN}, **{b: 256 + i for i, b in enumerate(_HIDDEN)}}
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class _Odd(Exception):
    """A space that may belong to more than the word behind it."""


class _Rare(Exception):
    """A letter of which the two pattern libraries may think otherwise."""


class _Letters(dict):
    """The signs for the bytes of each certain letter, for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        if code >= ord(_CERTAIN):
            raise _Rare
        self[code] = "".join(chr(_SIGNS[b]) for b in chr(code).encode())
        return self[code]


def _edge(c: str) -> bool:
    return c.isspace() or c in "\u180e\u200b"


class _Pieces(dict):
    """Ids of pieces that the tokenizer cuts no further, with or without their space in front.

    They make up the words that are not in the encoder's table. The pieces are forgotten when they are
    too many; what is met often is in the table as a word by then.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.raw = [int(i).to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.letters = _Letters()
        self.line_end = self["\n"]

    def __missing__(self, piece: str) -> bytes:
        raw = self.raw
        plain = piece.isascii() and piece.isprintable()
        signs = piece.replace(" ", "\u0120") if plain else piece.translate(self.letters)
        made = b"".join([raw[t.id] for t in self.tokenize(signs)])
        self[piece] = made
        return made

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def cut(self, text: str) -> bytes:
        """Ids of a text with no space at its ends, but for one in front of a word."""
        try:
            stem = text.rstrip(_MARKS)
            if (stem[1:] if stem[:1] == " " else stem).isalpha():
                return self[stem] + self[text[len(stem) :]] if len(stem) < len(text) else self[text]
            head, line, rest = text.partition("\n")
            if line and head and rest and not (_edge(head[-1]) or _edge(rest[0])):
                return self.cut(head) + self.line_end + self.cut(rest)
            return b"".join([self[p] for p in _PIECES.findall(text)])
        except _Rare:
            return self.whole(text)

    def led(self, word: str) -> bytes:
        """Ids of a word with a space in front."""
        if word.isalpha():
            return self.cut(" " + word)
        if not word or _edge(word[0]) or _edge(word[-1]):
            raise _Odd
        return self.cut(" " + word)

    def trim(self) -> None:
        if len(self) > PIECES_KEPT:
            self.clear()


class Encoder:
    """Encodes blocks of texts through their distinct words.

    The tokenizer cuts a text before every lone space in front of a word, so a text's ids are
    those of its space-led words in turn; a word is cut on by the tokenizer's own pattern. A block is
    split at spaces, its words are numbered and looked up in a table of words, all in Arrow; only words
    that are not in the table become Python strings, and join it. When the table is full, words that
    were not met since the last time go. The ids are put together by number. Texts with other runs of space, words with rare letters, and
    texts that hold the content of an added token go to the tokenizer as they are. So do all texts
    if the file's tokenizer does more, or cuts otherwise, than this shortcut knows. With
    ``special_as_text`` the names of special tokens in a text are ordinary text, else they give the
    tokens' ids as in the tokenizer's plain call.
    """

    def __init__(self, path: str, end_id: int, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = special_as_text
        added = tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if t.content and not (special_as_text and t.special)]
        self.plain = _is_plain(json.loads(tokenizer.to_str()))
        self.pieces, self.end = _Pieces(tokenizer), np.uint32(end_id).tobytes()
        # The table: words, their ids one after the other, and which were met since the last trim.
        self.known = pa.array([], pa.string())
        self.flat, self.sizes, self.met = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, bool)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text with the end id, as little-endian 32-bit numbers."""
        tokens, lengths = self.block(pa.array(texts, pa.string()))
        ends = np.cumsum(lengths)
        return [tokens[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, each with the end id, and the number of each text's ids."""
        pieces = self.pieces
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not n:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        whole = np.full(n, not self.plain)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = parts.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        place, odd = self._looked_up(coded.dictionary)
        # Further parts: first words, which no space leads, texts as a whole, nothing, and the end id.
        more: list[bytes] = []
        next_part = len(self.sizes)
        sizes = np.diff(bounds)
        later = odd[at]
        later[bounds[:-1]] = False
        whole |= np.add.reduceat(later, bounds[:-1], dtype=np.int64) > 0
        first = np.empty(n, np.int64)
        for t, word in enumerate(coded.dictionary.take(pa.array(at[bounds[:-1]])).to_pylist()):
            odd_first = not word or _edge(word[0]) or _edge(word[-1])
            if whole[t] or (sizes[t] > 1 and (not word or _edge(word[-1]))):
                whole[t] = True
                more.append(pieces.whole(texts[t].as_py()))
            else:
                more.append(pieces.whole(word) if odd_first else pieces.cut(word))
            first[t] = next_part + len(more) - 1
        nothing, end = next_part + len(more), next_part + len(more) + 1
        more += [b"", self.end]
        at = place[at]
        at[np.repeat(whole, sizes)] = nothing
        at[bounds[:-1]] = first
        order = np.empty(len(at) + n, np.int64)
        ends = bounds[1:] + np.arange(n)
        inner = np.ones(len(order), bool)
        inner[ends] = False
        order[inner], order[ends] = at, end
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(more), np.uint32)])
        part_sizes = np.concatenate([self.sizes, np.fromiter(map(len, more), np.int64, len(more)) // 4])
        tokens, counts = _gathered(flat, part_sizes, order)
        self._trim()
        return tokens, np.add.reduceat(counts, np.append(0, ends[:-1] + 1))

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The place of each distinct word in the table, new ones added; which ones are no plain words."""
        place = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64)
        odd = np.zeros(len(words), bool)
        new = np.flatnonzero(place < 0)
        self.met[place[place >= 0]] = True
        if len(new):
            missing = words.take(pa.array(new))
            made = []
            for k, word in enumerate(missing.to_pylist()):
                try:
                    made.append(self.pieces.led(word))
                except _Odd:
                    made.append(b"")
                    odd[new[k]] = True
            place[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, missing])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(made), np.uint32)])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, made), np.int64, len(made)) // 4])
            # A word is kept over a trim only if it is met a second time.
            self.met = np.concatenate([self.met, np.zeros(len(new), bool)])
            if odd.any():  # there are no ids to keep; they are found odd again next time
                self._keep(np.concatenate([np.ones(len(self.known) - len(new), bool), ~odd[new]]), place)
        return place, odd

    def _keep(self, kept: np.ndarray, place: np.ndarray | None = None) -> None:
        """Leave only some words in the table; ``place`` follows, to 0 for those that go."""
        self.known = self.known.filter(pa.array(kept))
        self.flat = self.flat[np.repeat(kept, self.sizes)]
        self.sizes, self.met = self.sizes[kept], self.met[kept]
        if place is not None:
            moved = np.cumsum(kept) - 1
            place[:] = np.where(kept[place], moved[place], 0)

    def _trim(self) -> None:
        if len(self.known) > WORDS_KEPT:
            self._keep(self.met.copy())
            self.met[:] = False
            if len(self.known) > WORDS_KEPT // 2:
                self._keep(np.arange(len(self.known)) >= len(self.known) - WORDS_KEPT // 2)
        self.pieces.trim()


def _gathered(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the parts that ``flat`` holds, taken in an order, and how many each place gave."""
    starts = np.cumsum(sizes) - sizes
    counts = sizes[order]
    ends = np.cumsum(counts)
    at = np.repeat(starts[order] - ends + counts, counts)
    at += np.arange(len(at))
    return flat[at], counts


def _is_plain(config: dict) -> bool:
    """Whether a tokenizer is byte-level BPE, cut by the known pattern, and nothing more."""
    cutter = config.get("pre_tokenizer") or {}
    model = config.get("model") or {}
    byte_level = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
    post = (config.get("post_processor") or {}).get("type")
    return bool(
        byte_level and not config.get("normalizer") and post in (None, "ByteLevel")
        and not config.get("truncation") and not config.get("padding") and model.get("type") == "BPE"
        and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    )


def pack(part: int, number: int, before: int, ids: list, lengths: list[int], tokens: np.ndarray) -> bytes:
    """The bytes of a shard file; ``before`` is the number of ids in its partition's earlier shards."""
    import zstandard

    matrix = WaveletMatrix.of(tokens)
    raw = [
        np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        np.array([i is None for i in ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
    ]
    for plane in matrix.planes:
        raw += [plane.words.astype("<u8").tobytes(), plane.ranks.astype("<u4").tobytes()]
    packer = zstandard.ZstdCompressor(level=1)
    sections = [packer.compress(r) for r in raw]
    header = json.dumps(
        {"part": part, "number": number, "before": before, "docs": len(ids), "tokens": len(tokens),
         "planes": len(matrix.planes), "sections": [len(s) for s in sections]}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class Shard:
    """A shard file: its documents and its wavelet matrix."""

    def __init__(self, body: bytes) -> None:
        import zstandard

        if body[:4] != MAGIC:
            raise ValueError("not a token shard")
        (n,) = struct.unpack("<I", body[4:8])
        head = json.loads(body[8 : 8 + n])
        at, raw, unpacker = 8 + n, [], zstandard.ZstdDecompressor()
        for size in head["sections"]:
            raw.append(unpacker.decompress(body[at : at + size]))
            at += size
        self.part, self.number, self.before = head["part"], head["number"], head["before"]
        nulls = np.frombuffer(raw[1], np.uint8)
        self.ids = [None if x else i for i, x in zip(np.frombuffer(raw[0], "<i8").tolist(), nulls)]
        self.lengths = np.frombuffer(raw[2], "<u8").astype(np.int64)
        size = head["tokens"]
        planes = [
            Plane(np.frombuffer(raw[i], "<u8"), np.frombuffer(raw[i + 1], "<u4"), size)
            for i in range(3, 3 + 2 * head["planes"], 2)
        ]
        self.matrix = WaveletMatrix(planes, size)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK_BYTES of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes, dtype=np.int64) - 1) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text: str = "text",
    special_as_text: bool = False,
) -> DataFrame:
    """Write the shards of ``docs`` under ``path``; a stored manifest: part, number, docs, tokens.

    ``special_as_text`` as in ``Encoder``; without it, the ids are those of the tokenizer's plain call.
    """
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    keys = ["id", F.xxhash64("text")]
    # A worker keeps its encoder, and the words it has learnt, from task to task.
    kept = docs.sparkSession.sparkContext.broadcast({})
    # The random number lets even equal rows be cut into several ranges.
    ordered = ordered.repartitionByRange(*keys, F.rand(0)).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), str(context.taskAttemptId())
        number, before = 0, 0
        ids: list = []
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def shards(final: bool) -> Iterator[pa.RecordBatch]:
            """Write what is held, but for an unfinished shard if more is to come."""
            nonlocal number, before, ids, lengths, held
            if not ids:
                return
            sizes, tokens = np.concatenate(lengths), np.concatenate(held)
            ends = np.cumsum(sizes)
            doc = done = 0
            while doc < len(ids):
                last = int(np.searchsorted(ends, done + shard_tokens))
                if last >= len(ids):
                    if not final:
                        break
                    last = len(ids) - 1
                stop = int(ends[last])
                body = pack(part, number, before, ids[doc : last + 1], sizes[doc : last + 1], tokens[done:stop])
                put_file(f"{path}/part-{part:06d}-{number:06d}.wmt", body, attempt)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                     "docs": pa.array([last + 1 - doc], pa.int64()), "tokens": pa.array([stop - done], pa.int64())}
                )
                number, before, doc, done = number + 1, before + stop - done, last + 1, stop
            ids, lengths, held = ids[doc:], [sizes[doc:]], [tokens[done:]]

        for batch in batches:
            if "encoder" not in kept.value:
                kept.value["encoder"] = Encoder(tokenizer, end_id, special_as_text)
            for some in _blocks(batch):
                tokens, sizes = kept.value["encoder"].block(some.column(1))
                ids += some.column(0).to_pylist()
                lengths.append(sizes)
                held.append(tokens)
                yield from shards(final=False)
        yield from shards(final=True)

    return stored(ordered.mapInArrow(run, "part int, number int, docs long, tokens long"), "manifest")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard files as rows of ``content``."""
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary")
    return files.format("binaryFile").option("pathGlobFilter", "part-*.wmt").load(path).select("content")


def decoded(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    The driver adds up one number per partition of the writing job; the rest is in the files.
    """
    starts, at = {}, 0
    for part, tokens in sorted(tuple(r) for r in manifest.groupBy("part").agg(F.sum("tokens")).collect()):
        starts[part] = at
        at += tokens
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not starts:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                shard = Shard(body.as_py())
                raw = memoryview(shard.matrix.decode().astype("<u4", copy=False)).cast("B")
                ends = np.cumsum(shard.lengths)
                begins = ends - shard.lengths
                crcs = [crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(shard.ids, pa.int64()),
                     "start": pa.array(begins + starts[shard.part] + shard.before, pa.int64()),
                     "n_tokens": pa.array(shard.lengths, pa.int64()),
                     "ids_crc32": pa.array(crcs, pa.int64())}
                )

    return read_shards(spark, path).mapInArrow(run, schema)


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of a token by rank and select: doc_id and position in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                shard = Shard(body.as_py())
                at = shard.matrix.occurrences(token)
                ends = np.cumsum(shard.lengths)
                doc = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([shard.ids[i] for i in doc], pa.int64()),
                     "position": pa.array(at - (ends - shard.lengths)[doc], pa.int64())}
                )

    return read_shards(spark, path).mapInArrow(run, "doc_id long, position long")


def count_token(spark: SparkSession, path: str, token: int) -> int:
    """How often a token occurs in all shards, by two ranks on every plane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(Shard(body.as_py()).matrix.count(token) for body in batch.column(0))
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return read_shards(spark, path).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
