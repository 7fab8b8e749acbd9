"""Token ids as binary files of Simple-8b words.

A 64-bit word is a selector in its top four bits and, below it, as many ids of
one width as fit into 60 bits: 60 of one bit up to one of 60 bits, or a run of
120 zeros.  An id beyond 60 bits is an escape: its word holds selector 0 and its
value stands whole among the block's escapes, in order.

A file (little-endian):

    magic
    blocks   each: words (u64), then escapes (u64)
    documents  present (u8, 0: null id), id (i64), number of ids (u64), as columns
    index    per block: byte offset, ids before it, words, escapes (u64), crc32 of the block (u64)
    footer   documents, blocks, ids, offset of the documents, offset of the index (u64), magic

A document's ids begin with a new word and go on over as many blocks as they
need.  Every block can be decoded on its own, all its words at once: counts by
selector, places as their running sum, then one shift and mask per selector.

Documents are dealt by ranges of doc_id and sorted there, and tokenised in that
order.  A task writes its part in files of about ``FILE_BYTES``, one held at a
time, under names in dataset order; a table of the files beside them says how
many ids each holds.  Only files that this table names are read, so what lost
tasks left behind does not count.

Defined results: null and empty texts are the end id alone; null ids come last;
rows of one id are in the order of a hash of their texts; an empty table gives no
files and no rows; further columns are ignored.  Texts that hold a special
token's string go through the tokenizer whole, which takes it for the token.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table, worker_cache
from textmill.llm.packing import tokenizer_path
from textmill.session import scratch_path, written

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"TIDS8B01"
#: (ids in a word, bits of each) by selector from 1 on; 0 is the escape.
WIDTHS = [(120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
          (3, 20), (2, 30), (1, 60)]
BLOCK_WORDS = 8192
FILE_BYTES = 16 << 20
#: Text bytes per task.
PART_BYTES = 32 << 20
CACHED = 400_000
#: Longer pieces are not kept.
LONG = 40
#: Text bytes cut into words at once.
TOGETHER = 8 << 20
_FOOTER = "<5Q8s"
_FOOTER_BYTES = 48
_INDEX = 5
#: White space, for regular expressions that know ASCII only.
_SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The vocabulary's own splitting rule (fixed by its file).
_PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TokenFileError(ValueError):
    """A file that breaks the format."""


# -- coding ----------------------------------------------------------------

def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs; numbers up to 2**53 are exact as floats."""
    high = ids >> np.uint64(32)
    if high.any():
        return np.where(high != 0, np.frexp(high.astype(np.float64))[1] + 32, np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.uint8)
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def _room(bits: np.ndarray) -> np.ndarray:
    """The selector of a word that begins at each place: the most ids of which
    all fit.  ``bits`` has 255 after every list, which fits nowhere."""
    least = np.zeros(len(bits), np.uint8)  # words that hold more ids fit only where all with fewer do
    wide, half = bits, 1  # most bits among the next ``half``
    for n, width in reversed(WIDTHS):  # each n is at most twice the one before
        if n > 1:
            size = len(bits) - n + half
            both = np.maximum(wide[:size], wide[n - half:])
            wide = np.full(len(bits), 255, np.uint8)
            wide[:max(0, len(bits) - n + 1)] = both[:max(0, len(bits) - n + 1)]
            half = n
        fits = wide <= width
        if not fits.any():
            break
        least += fits
    return np.where(least > 0, len(WIDTHS) + 1 - least, 0).astype(np.uint8)


def encode(lists: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """(words, escapes) of each list of ids (unsigned 64-bit), coded together."""
    if not lists:
        return []
    sizes = np.array([len(x) for x in lists], np.int64)
    ends = np.cumsum(sizes + 1)
    ids = np.zeros(int(ends[-1]), np.uint64)
    inside = np.ones(len(ids), bool)
    inside[ends - 1] = False
    ids[inside] = np.concatenate(lists).astype(np.uint64, copy=False)
    bits = _bits(ids)
    bits[ends - 1] = 255
    best = _room(bits)
    step = np.array([1] + [n for n, _ in WIDTHS], np.uint8)[best].tobytes()
    at, i = [], 0
    while i < len(step):
        at.append(i)
        i += step[i]
    at = np.array(at, np.int64)
    at = at[inside[at]]
    selector = best[at]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        n, width = WIDTHS[s - 1] if s else (0, 0)
        if width:
            mine = np.flatnonzero(selector == s)
            word = np.zeros(len(mine), np.uint64)
            for k in range(n):
                word |= ids[at[mine] + k] << np.uint64(k * width)
            words[mine] |= word
    escapes = ids[at[selector == 0]]
    starts = np.concatenate(([0], ends[:-1]))
    word_cut = np.searchsorted(at, np.append(starts, ends[-1]))
    before = np.concatenate(([0], np.cumsum(selector == 0)))[word_cut]
    return [(words[word_cut[i]:word_cut[i + 1]].astype("<u8").tobytes(), escapes[before[i]:before[i + 1]].astype("<u8").tobytes())
            for i in range(len(lists))]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of a block's words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    n = np.array([1] + [c for c, _ in WIDTHS], np.int64)[selector]
    place = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint64)
    for s in np.unique(selector):
        mine = selector == s
        if s == 0:
            if mine.sum() != len(escapes):
                raise TokenFileError("escapes do not fit the words")
            out[place[mine]] = escapes
            continue
        count, width = WIDTHS[s - 1]
        if width:
            mask, at, w = np.uint64((1 << width) - 1), place[mine], words[mine]
            for k in range(count):
                out[at + k] = (w >> np.uint64(k * width)) & mask
    return out


def block_ids(words: np.ndarray) -> int:
    """How many ids a block's words hold."""
    return int(np.array([1] + [c for c, _ in WIDTHS], np.int64)[(words >> np.uint64(60)).astype(np.int64)].sum())


# -- files -----------------------------------------------------------------

class FileBytes:
    """One file being put together."""

    def __init__(self, block_words: int = BLOCK_WORDS):
        self.out = bytearray(MAGIC)
        self.limit = 8 * block_words
        self.words, self.escapes = bytearray(), bytearray()
        self.ids: list = []
        self.sizes: list[int] = []
        self.index: list[tuple] = []
        self.n_ids = 0

    def __len__(self) -> int:
        return len(self.out) + len(self.words) + len(self.escapes)

    def add(self, doc_id: int | None, n_tokens: int, words: bytes, escapes: bytes) -> None:
        self.ids.append(doc_id)
        self.sizes.append(n_tokens)
        used = 0
        for lo in range(0, len(words), self.limit):
            part = words[lo:lo + self.limit]
            if len(self.words) + len(part) > self.limit:
                self._close()
            n = 8 * int((np.frombuffer(part, "<u8") >> np.uint64(60) == 0).sum()) if escapes else 0
            self.words += part
            self.escapes += escapes[used:used + n]
            used += n

    def _close(self) -> None:
        if self.words:
            n = block_ids(np.frombuffer(bytes(self.words), "<u8"))
            body = bytes(self.words + self.escapes)
            self.index.append((len(self.out), self.n_ids, len(self.words) // 8, len(self.escapes) // 8, zlib.crc32(body)))
            self.out += body
            self.n_ids += n
            self.words, self.escapes = bytearray(), bytearray()

    def finish(self) -> bytes:
        self._close()
        documents = len(self.out)
        self.out += np.array([i is not None for i in self.ids], np.uint8).tobytes()
        self.out += np.array([i or 0 for i in self.ids], "<i8").tobytes()
        self.out += np.array(self.sizes, "<u8").tobytes()
        index = len(self.out)
        self.out += np.array(self.index, "<u8").reshape(-1, _INDEX).tobytes()
        self.out += struct.pack(_FOOTER, len(self.ids), len(self.index), self.n_ids, documents, index, MAGIC)
        return bytes(self.out)


class TokenFile:
    """A file's bytes, opened: ``doc_ids``, ``sizes`` and ids by block."""

    def __init__(self, data: bytes):
        try:
            n, blocks, self.n_ids, documents, index, magic = struct.unpack(_FOOTER, data[-_FOOTER_BYTES:])
            if magic != MAGIC or data[:len(MAGIC)] != MAGIC:
                raise TokenFileError("no token file")
            self.data = data
            present = np.frombuffer(data, np.uint8, n, documents)
            ids = np.frombuffer(data, "<i8", n, documents + n).tolist()
            self.doc_ids = [i if p else None for i, p in zip(ids, present.tolist())]
            self.sizes = np.frombuffer(data, "<u8", n, documents + 9 * n).astype(np.int64)
            self.index = np.frombuffer(data, "<u8", blocks * _INDEX, index).astype(np.int64).reshape(-1, _INDEX)
        except (struct.error, ValueError) as e:
            raise TokenFileError(str(e)) from e
        if int(self.sizes.sum()) != self.n_ids:
            raise TokenFileError("documents and ids differ in number")

    def block(self, i: int) -> np.ndarray:
        """The ids of block ``i``."""
        at, _, n, escapes, crc = self.index[i].tolist()
        body = self.data[at:at + 8 * (n + escapes)]
        if zlib.crc32(body) != crc:
            raise TokenFileError(f"block {i} is damaged")
        return decode(np.frombuffer(body, "<u8", n), np.frombuffer(body, "<u8", escapes, 8 * n))

    def document(self, i: int) -> np.ndarray:
        """The ids of the document at place ``i``, from its own blocks only."""
        lo = int(self.sizes[:i].sum())
        hi = lo + int(self.sizes[i])
        first = max(0, int(np.searchsorted(self.index[:, 1], lo, "right")) - 1)
        parts, k = [], first
        while k < len(self.index) and self.index[k, 1] < hi:
            parts.append(self.block(k))
            k += 1
        base = int(self.index[first, 1]) if len(self.index) else 0
        return np.concatenate(parts)[lo - base:hi - base] if parts else np.empty(0, np.uint64)

    def documents(self):
        """(place, parts of its ids) of every document, a block held at a time:
        ``None`` in place of parts ends a document."""
        doc, left = 0, int(self.sizes[0]) if len(self.sizes) else 0
        for k in range(len(self.index)):
            ids = self.block(k)
            at = 0
            while at < len(ids) or (doc < len(self.sizes) and left == 0):
                if left == 0:
                    yield doc, None
                    doc += 1
                    left = int(self.sizes[doc]) if doc < len(self.sizes) else 0
                    if doc >= len(self.sizes):
                        break
                    continue
                part = ids[at:at + left]
                yield doc, part
                at += len(part)
                left -= len(part)
        while doc < len(self.sizes):
            if left:
                raise TokenFileError("ids are missing")
            yield doc, None
            doc += 1
            left = int(self.sizes[doc]) if doc < len(self.sizes) else 0


# -- tokens ----------------------------------------------------------------

def _byte_letters() -> list[str]:
    """The letter of each byte in byte-level vocabularies: its Latin-1 letter if
    that is visible, else the letters from U+0100 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class ByteIds:
    """Token ids of texts by a byte-level tokenizer.  Tokens stay inside the
    pieces of its splitting rule, and a space that no white space follows always
    begins a piece; so each different word after a space is tokenised once and
    kept, up to ``limit`` of them, then the table starts anew."""

    def __init__(self, path: str, limit: int = CACHED):
        import json

        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokens = self.whole.model.tokenize
        self.split = regex.compile(_PRETOKEN).findall
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.loose = "|".join([f" [{_SPACES}]", r" \z", *map(regex.escape, self.special)])
        rule = json.loads(self.whole.to_str())["pre_tokenizer"]
        if rule["type"] != "ByteLevel" or rule["add_prefix_space"] or not rule["use_regex"]:
            raise ValueError(f"{path} is no byte-level tokenizer of the known splitting rule")
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}  # words without the space before them
        self.limit = limit

    def _ids(self, piece: str) -> bytes:
        letters = "".join([self.letters[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokens(letters)])

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self._ids(piece)
            if len(piece) <= LONG:
                self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a space and ``word``; an empty word is only a text's first."""
        if not word:
            return b""
        if word.isalpha():
            ids = self._ids(" " + word) if not word.isascii() else b"".join(
                [t.id.to_bytes(4, "little") for t in self.tokens(self.letters[32] + word)])
            if len(word) <= LONG:
                self.spaced[word] = ids
            return ids
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return (self.spaced.get(word[:-1]) or self._word(word[:-1])) + self._piece(word[-1])
        return b"".join(map(self._piece, self.split(" " + word)))

    def of(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._piece, self.split(text)))

    def of_all(self, texts: pa.Array):
        """The ids (unsigned 32-bit) of each text, in order.  Texts are cut at
        their spaces together and only their different words looked up; those
        that ``loose`` matches or that hold a special token go one by one."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TOGETHER, "right")))
            yield from self._of_some(texts.slice(lo, hi - lo))
            lo = hi

    def _of_some(self, texts: pa.Array):
        if len(self.pieces) + len(self.spaced) > self.limit:
            self.pieces.clear()
            self.spaced.clear()
        odd = pc.match_substring_regex(texts, self.loose)
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        words = parts.flatten().dictionary_encode()
        which, first = words.indices.to_numpy().astype(np.int64), parts.offsets.to_numpy()[:-1].astype(np.int64)
        first -= first[0]
        different = words.dictionary.to_pylist()
        got = [self._word(w) if g is None else g for g, w in zip(map(self.spaced.get, different), different)]
        # A text's first word has no space before it; a text that goes alone is one word.
        alone = dict(zip(np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist(), texts.filter(odd).to_pylist()))
        got += [self.of(alone[i]) if i in alone else b"".join(map(self._piece, self.split(different[w])))
                for i, w in enumerate(which[first].tolist())]
        which[first] = len(different) + np.arange(len(first))
        ids = np.frombuffer(b"".join(got), "<u4")
        n = np.fromiter(map(len, got), np.int64, len(got)) // 4
        starts, n_of = np.cumsum(n) - n, n[which]
        ends = np.cumsum(n_of)
        out = ids[np.repeat(starts[which] - (ends - n_of), n_of) + np.arange(int(ends[-1]))]
        yield from np.split(out, (ends - n_of)[first[1:]])


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
                      part_bytes: int = PART_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Write the token ids of ``docs`` (doc_id, text) below ``folder``; the table
    of files (file, n_docs, n_ids, part, number).  ``tokenizer`` is a path that
    every executor can open."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    end = np.uint32(end_id)
    arrow = pa.schema([("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("part", pa.int32()), ("number", pa.int32())])

    def run(batches):
        from pyspark import TaskContext

        cache = worker_cache("byte_ids")
        if tokenizer not in cache:
            cache[tokenizer] = ByteIds(tokenizer)
        ids_of = cache[tokenizer].of_all
        store, root = _store(folder)
        part, done = TaskContext.get().partitionId(), []

        def put(file: FileBytes) -> None:
            name = f"part-{part:06d}-{len(done):06d}.tids"
            temporary = f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as f:
                f.write(file.finish())
            if store.get_file_info(f"{root}/{name}").is_file:  # an earlier try of this task
                store.delete_file(f"{root}/{name}")
            store.move(temporary, f"{root}/{name}")
            done.append({"file": name, "n_docs": len(file.ids), "n_ids": file.n_ids, "part": part, "number": len(done)})

        def coded():
            held, size = [], 0
            for b in batches:
                for doc_id, ids in zip(b.column("doc_id").to_pylist(), ids_of(b.column("text"))):
                    ids = np.append(ids, end)
                    held.append((doc_id, ids))
                    size += len(ids)
                    if size > 1 << 20:  # ids coded together
                        yield held
                        held, size = [], 0
            yield held

        file = None
        for held in coded():
            for (doc_id, ids), (words, escapes) in zip(held, encode([x for _, x in held])):
                file = file or FileBytes(block_words)
                file.add(doc_id, len(ids), words, escapes)
                if len(file) >= file_bytes:
                    put(file)
                    file = None
        if file:
            put(file)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    order = [F.asc_nulls_last("doc_id"), "tie", "row"]
    dealt = (docs.select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
             .repartitionByRange(max(1, -(-size // part_bytes)), *order).sortWithinPartitions(*order))
    return written(dealt.select("doc_id", "text").mapInArrow(run, "file string, n_docs bigint, n_ids bigint, part int, number int"),
                   "token-files")


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """A row per document of the token files below ``folder`` that ``files``
    names: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.
    A file that breaks the format fails the read."""
    def run(batches):
        for b in batches:
            for path, data in zip(b["path"], b["content"]):
                try:
                    f = TokenFile(data)
                    crc = np.zeros(len(f.sizes), np.int64)
                    now = 0
                    for doc, ids in f.documents():
                        if ids is None:
                            crc[doc], now = now, 0
                        else:
                            now = zlib.crc32(ids.astype("<u4").tobytes(), now)
                except TokenFileError as e:
                    raise TokenFileError(f"{path}: {e}") from e
                name = [path.rpartition("/")[2]]
                starts = np.cumsum(f.sizes) - f.sizes
                for lo in range(0, len(crc), 10_000):
                    to = slice(lo, lo + 10_000)
                    yield {"file": name * len(crc[to]), "doc_id": f.doc_ids[to], "within": starts[to], "n_tokens": f.sizes[to],
                           "ids_crc32": crc[to]}

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tids").load(folder).select("path", "content")
    docs = map_rows(found, run, "file string, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    # One row per file: what the files before it hold.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    base = written(files.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")), "file-bases")
    return docs.join(base, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def op13_token_files(spark, sf_dir):
    """All documents' token ids written as files and read back."""
    folder = scratch_path(spark, "token-ids")
    files = write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path(TOKENIZER))
    return read_token_files(spark, folder, files)
